"""Periodic runs against plain enumeration."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm.fixtures import doc_rows, documents
from sluice.llm import runs
from sluice.llm.common import table
from sluice.llm.queries import QUERIES


def brute_runs(words, least=6, exponent=4):
    """Every maximal stretch of every period, without those of a smaller one."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(least, exponent * q):
                found.setdefault((start, i), q)       # periods come from the smallest on
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapse(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(words):
    found = brute_runs(words)
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha256(lines.encode()).hexdigest(), sha256(" ".join(brute_collapse(words, found)).encode()).hexdigest())


def random_words(rnd):
    kind = rnd.randrange(5)
    letters = "ab" if kind < 2 else "abcdef"
    words = [rnd.choice(letters) for _ in range(rnd.randrange(0, 60))]
    if kind == 2:
        words = ["a"] * rnd.randrange(1, 40)
    for _ in range(rnd.randrange(0, 4)):
        at, unit = rnd.randrange(len(words) + 1), [rnd.choice(letters) for _ in range(rnd.randrange(1, 14))]
        words[at:at] = (unit * rnd.randrange(2, 9))[:rnd.randrange(1, 90)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_enumeration(seed, monkeypatch):
    monkeypatch.setattr(runs, "GROUP", 300)           # texts in many groups
    rnd = random.Random(seed)
    texts = [random_words(rnd) for _ in range(500)]
    got = list(runs.runs_of_texts([" ".join(t).encode() for t in texts]))
    assert len(got) == len(texts)
    for words, (found, collapsed) in zip(texts, got):
        assert found == brute_runs(words)
        assert collapsed.decode() == " ".join(brute_collapse(words, found))


def test_other_limits_equal_enumeration():
    rnd = random.Random(9)
    texts = [random_words(rnd) for _ in range(300)]
    for least, exponent in ((1, 3), (12, 3), (3, 6)):
        got = runs.runs_of_texts([" ".join(t).encode() for t in texts], least, exponent)
        assert [f for f, _ in got] == [brute_runs(t, least, exponent) for t in texts]


def test_one_word_over_and_over_is_linear():
    word = [b"the"] * 300_000
    assert next(runs.runs_of_texts([b" ".join(word)])) == ([(0, 300_000, 1)], b"the")
    pair = [b"a", b"b"] * 150_000
    assert next(runs.runs_of_texts([b" ".join(pair)])) == ([(0, 300_000, 2)], b"a b")


def test_odd_rows(spark):
    rows = doc_rows() + [(20, "a b " * 9, "en", "a", 1), (20, "a b " * 9, "en", "a", 1), (21, "x y " * 8, "en", "a", 1)]
    got = runs.periodic_runs(documents(spark, rows)).collect()
    want = []
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        found = brute_runs(words) if len(words) < 1000 else []
        want.append((i, found, b" ".join(brute_collapse(words, found)).decode()))
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)
    assert runs.periodic_runs(documents(spark, []), id_col="doc_id").count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(documents(spark), exponent=2)


def test_query_equals_enumeration(spark):
    docs = table(spark, SF001, "documents")
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF001).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        want = digest(planted(words, doc_id)) if len(words) < 3000 else None
        r = got[doc_id]
        some += r.n_runs > 0
        if want:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
    assert some


def test_planting_equals_the_contract(spark):
    from sluice.llm.queries import with_planted_repeats

    rows = [(i, " ".join(f"w{j * j % 11}" for j in range(i % 70)), "en", "a", 1) for i in range(400)]
    rows += [(None, "a b c", "en", "a", 1), (7, None, "en", "a", 1), (8, "", "en", "a", 1)]
    docs = documents(spark, rows)
    got = with_planted_repeats(docs.select("doc_id", "text")).withColumn("n", F.lit(1)).collect()
    want = [(i, planted((t or "").split(), i)) for i, t, *_ in rows]
    assert sorted(((r.doc_id, (r.text or "").split()) for r in got), key=repr) == sorted(want, key=repr)
