"""The subsequence kernel against plain enumeration, pieces of long texts, and
that nothing of a group of texts stays behind."""

from __future__ import annotations

import gc
import math
import random

import numpy as np
import pytest

from sluice.llm import toxicity


def plain_features(width, text):
    """[(subsequence, weight)] of a span: each start inside, each choice of gaps."""
    out = []
    for start in range(min(width, len(text))):
        for shape in toxicity._SHAPES:
            if start + shape[-1] < len(text):
                gaps = shape[-1] + 1 - len(shape)
                out.append((tuple(text[start + o] for o in shape), toxicity.DECAY ** gaps))
    norm = math.sqrt(max(sum(w * w for _, w in out), toxicity._LEAST))
    return [(s, w / norm) for s, w in out]


def plain_kernel(a, b):
    own: dict = {}
    for s, w in plain_features(*b):
        own[s] = own.get(s, 0.0) + w
    return sum(w * own.get(s, 0.0) for s, w in plain_features(*a))


def some_spans(seed, n=12):
    rnd = random.Random(seed)
    words = ["idiot", "idi0t", "i d i o t", "garden", "gardens", "ünï", "x", "abcabcabc", "the end"]
    out = []
    for _ in range(n):
        text = " " + " ".join(rnd.choices(words, k=rnd.randrange(1, 6))) + " "
        w = rnd.choice(toxicity.WIDTHS)
        out.append((w, text[:w + toxicity._REACH]))
    return out


def test_shapes_are_all_subsequences_within_the_gap():
    want = {s for p in toxicity.LENGTHS for s in
            [(0, *c) for c in __import__("itertools").combinations(range(1, 12), p - 1)] if s[-1] + 1 - p <= toxicity.GAP}
    assert set(toxicity._SHAPES) == want


@pytest.mark.parametrize("seed", range(4))
def test_kernel_equals_enumeration(seed, monkeypatch):
    monkeypatch.setattr(toxicity, "BITS", 24)       # hardly a collision
    spans = some_spans(seed)
    prior = np.zeros(1 << toxicity.BITS, dtype=np.float32)
    kernel, _, _, _ = toxicity._similarities(spans, spans, prior)
    for i, a in enumerate(spans):
        for j, b in enumerate(spans):
            assert abs(kernel[i, j] - plain_kernel(a, b)) < 1e-3


def test_values_of_spans_equal_their_features():
    rng = np.random.default_rng(1)
    weight = rng.normal(size=1 << toxicity.BITS).astype(np.float32)
    text = toxicity.reading("You i-d-i-o-t, the garden of gardens ends here; 1234 and so on and on.")
    chars, at, values = toxicity._spans([text], weight, 0.25)
    assert len(at) == len(text)
    for w, got in zip(toxicity.WIDTHS, values):
        spans = [(w, text[i:i + w + toxicity._REACH]) for i in range(len(text))]
        keys, weights = toxicity.subsequences(spans)
        want = np.einsum("ij,ij->i", weight[keys], weights) + 0.25
        assert np.allclose(got, want, atol=2e-4)


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(2)
    weight = rng.normal(size=1 << toxicity.BITS).astype(np.float32)
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices(["alpha", "b", "gamma1", "δδδ"], k=n)) for n in (900, 3, 40, 0, 300)] + [None, "!!"]
    whole = toxicity.measured(texts, weight, 0.1, spans=True)
    for piece in (64, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        for a, b in zip(toxicity.measured(texts, weight, 0.1, spans=True), whole):
            assert (a is None) == (b is None)
            if a is not None:
                assert a[0] == pytest.approx(b[0], abs=1e-5) and a[1] == pytest.approx(b[1], rel=1e-5) and a[2] == b[2]


def test_no_array_outlives_its_group():
    chars = np.arange(5000, dtype=np.uint32) % 50 + 97
    weight = np.zeros(1 << toxicity.BITS, dtype=np.float32)
    gc.collect()
    gc.disable()
    try:
        for _ in toxicity.hashed(chars, 4000):
            pass
        toxicity.measured(["some words " * 500], weight, 0.0)
        assert gc.collect() == 0          # nothing but the cycle collector could have freed it
    finally:
        gc.enable()
