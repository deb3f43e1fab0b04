"""Toxicity by a subsequence string-kernel support vector machine.

The kernel compares two spans of text by the character subsequences of length
3 and 4 that they share, inside words and across white space; a subsequence may
skip up to ``GAP`` characters, each at the price of ``DECAY``. Inserted, dropped
or swapped characters and spaces thus cost a span only some of its
subsequences. A span's subsequences can be listed, so the trained function is
one weight per (hashed) subsequence.

Training is by labelled documents (of equal texts once); there is no word list.

1. Every subsequence gets the shrunk log ratio of its share among toxic
   documents. All count, so rare inflections of a stem add up.
2. A toxic document is known to hold some toxic span, a clean one none. Of each
   toxic document the highest spans are positive; spans of clean documents by
   hash, and the highest ones, are negative. A squared-hinge machine is fitted
   to them (and to the positive ones with a letter or a space more) in the
   Nystroem space of ``LANDMARKS`` spans and the log ratios, and the spans are
   chosen again with it, ``TURNS`` times.
3. Two logistic curves give a document's score: one of its highest span alone
   (one insult is enough, however short the text), one also of how much of it
   lies in positive spans (evidence by count). The higher one counts.

Fitting uses at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled documents, taken
by the hash of their id. Training and scoring read the same spans: those of
``WIDTHS`` characters from every character of every text, in lower case, with
letters and digits only, one space between words, and runs of three or more
single characters as one word.

Nulls: null and empty texts and such without letters or digits get the lowest
value of the fitted rows and no evidence. Null ids are kept; they train nothing.
Labels that are null or neither 0 nor 1 are left out, and of repeated labels the
highest counts. Without a toxic or without a clean label every score is 0.
Empty tables give no rows; other columns are ignored, and ``clean_documents``
returns them as they are.
"""

from __future__ import annotations

import re
from functools import partial
from itertools import combinations
from math import log
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import crc_of_id, materialise, ship

LENGTHS = (3, 4)
GAP = 2
DECAY = 0.7
BITS = 18            # subsequences are hashed to 2^BITS weights
WIDTHS = (10, 24)    # characters of a span: about a word, and a few words
LANDMARKS = 256
TOXIC_ROWS = 3000
CLEAN_ROWS = 24000
NEGATIVES = 5000     # spans of clean documents by hash
HARD = 2000          # highest spans of clean documents, added each turn
TURNS = 2
OTHERS = 4           # narrow spans above 0 of a toxic document that are positive too
POSITIVES = 6000     # of these, by hash
VARIED = 3000        # positive spans also learnt with a letter or a space more
SHRINK = 5.0         # documents that a subsequence's share is pulled to the mean by
PIECE = 1 << 16      # characters read at once
ROWS = 256           # texts that are Python strings at once
THRESHOLD = 0.3

_SHAPES = [(0, *c) for p in LENGTHS for c in combinations(range(1, p + GAP), p - 1)]
_REACH = max(s[-1] for s in _SHAPES)
_NOT_WORD = re.compile(r"[^\w\s]+|_+")
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")


def _price(shape: tuple) -> float:
    return DECAY ** (shape[-1] + 1 - len(shape))


_ENERGY = {z: sum(_price(s) ** 2 for s in _SHAPES if s[-1] == z) for z in {s[-1] for s in _SHAPES}}
_LEAST = 6 * sum(_ENERGY.values())        # a span's norm is that of six characters at least


def reading(text: str | None) -> str:
    """Words of letters and digits with a space around each."""
    text = _NOT_WORD.sub("", (text or "").lower())
    text = _SINGLES.sub(lambda m: "".join(m.group().split()), text)
    words = " ".join(text.split())
    return f" {words} " if words else ""


def hashed(chars: np.ndarray, n: int):
    """(shape, hash of the subsequence that starts at each of the first n
    places) along the last axis."""
    known: dict[tuple, np.ndarray] = {}
    longest = max(LENGTHS)
    for shape in _SHAPES:
        for end in range(1, len(shape) + 1):              # its prefixes, from the shortest
            start = shape[:end]
            if start not in known:
                at = chars[..., start[-1]:start[-1] + n]
                k = known[start[:-1]] + at if end > 1 else at.copy()
                k *= np.uint32(0x9E3779B1)
                k ^= k >> np.uint32(15)
                known[start] = k
        k = known[shape] if len(shape) < longest else known.pop(shape)      # no prefix of another
        k = (k + np.uint32(len(shape))) * np.uint32(0x85EBCA6B)
        yield shape, (k >> np.uint32(32 - BITS)).astype(np.int32)


def _packed(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all pieces with zeros between, start and size of each."""
    gap = "\0" * _REACH
    flat = gap + "".join(p + gap for p in pieces)
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    return (np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype="<u4"),
            np.cumsum(size + _REACH) - size, size)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])


def _spans(pieces: list[str], weight: np.ndarray, bias: float):
    """The characters, and for each piece's places one after another: the
    place, and the values of the spans of ``WIDTHS`` from there."""
    chars, start, size = _packed(pieces)
    n = len(chars) - _REACH
    there = chars > 0
    by_last = {z: np.zeros(n, dtype=np.float32) for z in _ENERGY}
    for shape, k in hashed(chars, n):
        by_last[shape[-1]] += weight[k] * np.float32(_price(shape))
    value, energy = np.zeros(n, dtype=np.float32), np.zeros(n, dtype=np.float32)
    for z, v in by_last.items():
        whole = there[:n] & there[z:z + n]
        value += v * whole
        energy += np.float32(_ENERGY[z]) * whole
    value, energy = _sums(value), _sums(energy)
    end = np.repeat(start + size, size)
    at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
    out = []
    for width in WIDTHS:
        to = np.minimum(np.minimum(at + width, end), n)
        out.append((value[to] - value[at]) / np.sqrt(np.maximum(energy[to] - energy[at], _LEAST)) + bias)
    return chars, at, out


def measured(texts: list, weight: np.ndarray, bias: float, spans: bool = False):
    """(highest value, evidence, its span or None) of each text; None for a
    text without words. Evidence is the sum of the positive values of the
    narrow spans, per width."""
    found: list = [None] * len(texts)
    over = max(WIDTHS) + _REACH

    def flush(group):
        pieces = [p for _, p, _ in group]
        chars, at, values = _spans(pieces, weight, bias)
        first = 0
        for i, p, own in group:
            part = slice(first, first + min(own, len(p)))
            w = max(range(len(WIDTHS)), key=lambda j: values[j][part].max())
            best = int(values[w][part].argmax()) + first
            top, hits = float(values[w][best]), float(np.maximum(values[0][part], 0).sum()) / WIDTHS[0]
            first += len(p)
            old = found[i]
            span = old[2] if old else None
            if spans and (not old or top > old[0]):
                span = (WIDTHS[w], _cut(chars[at[best]:at[best] + WIDTHS[w] + _REACH]))
            found[i] = (max(top, old[0]) if old else top, hits + (old[1] if old else 0.0), span)

    group, size = [], 0
    for i, text in enumerate(texts):
        text = reading(text)
        for a in range(0, len(text), PIECE):
            piece = text[a:a + PIECE + over]
            if group and size + len(piece) > PIECE:
                flush(group)
                group, size = [], 0
            group.append((i, piece, PIECE))
            size += len(piece)
    if group:
        flush(group)
    return found


def _cut(chars: np.ndarray) -> str:
    """The characters before the first zero."""
    zero = np.flatnonzero(chars == 0)
    return chars[:zero[0] if len(zero) else len(chars)].tobytes().decode("utf-32-le", "surrogatepass")


def subsequences(spans: list[tuple[int, str]]):
    """(hashed features, their weights) of spans (width, characters, with those
    that the last subsequences reach): matrices with a row per span, weights of
    norm 1 (less for spans of few characters)."""
    width = max(WIDTHS)
    chars = np.zeros((len(spans), width + _REACH), dtype=np.uint32)
    for row, (_, text) in zip(chars, spans):
        row[:len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = np.arange(width) < np.array([w for w, _ in spans])[:, None]
    keys, weights = [], []
    for shape, k in hashed(chars, width):
        keys.append(k)
        weights.append(((chars[:, shape[-1]:shape[-1] + width] > 0) & inside) * np.float32(_price(shape)))
    keys, weights = np.concatenate(keys, axis=1), np.concatenate(weights, axis=1)
    norm = np.sqrt(np.maximum(np.einsum("ij,ij->i", weights, weights), _LEAST))
    return keys, weights / norm[:, None].astype(np.float32)


def _similarities(of: list, to: list, prior: np.ndarray):
    """The kernel of spans and landmarks, a landmark at a time, the value of
    the spans by ``prior``, and the landmarks' features."""
    own, own_weights = subsequences(to)
    kernel, value = np.empty((len(of), len(to))), np.empty(len(of))
    spread = np.zeros(1 << BITS, dtype=np.float32)
    for at in range(0, len(of), 2000):
        part = slice(at, at + 2000)
        keys, weights = subsequences(of[part])
        value[part] = np.einsum("ij,ij->i", prior[keys], weights)
        for j in range(len(to)):
            np.add.at(spread, own[j], own_weights[j])
            kernel[part, j] = np.einsum("ij,ij->i", spread[keys], weights)
            spread[own[j]] = 0
    return kernel, value, own, own_weights


def variants(spans: list, most: int) -> list:
    """Up to ``most`` of the spans with a letter or a space more inside: what
    the machine shall bear."""
    each = max(1, min(12, most // max(1, len(spans))))
    out = []
    for w, t in _spread(spans, most):
        h = hash_of(t)
        for i in range(each if len(t) > 5 else 0):
            at = 2 + (h + i * 7) % (min(w, len(t)) - 3)
            extra = " " if (h + i) % 2 else "xaeiourstnlq0"[(h // 64 + i) % 13]
            if " " not in t[at - 1:at + 1]:
                out.append((w, (t[:at] + extra + t[at:])[:w + _REACH]))
    return out


def fit(positive: list, varied: list, negative: list, hard: list, landmarks: list, prior: np.ndarray):
    """One weight per subsequence, a bias, and the values of the positive and
    varied spans: squared-hinge machine on the
    Nystroem features of the landmarks and the value by ``prior``, by Newton
    steps."""
    gram, _, _, _ = _similarities(landmarks, landmarks, prior)
    power, turn = np.linalg.eigh((gram + gram.T) / 2)
    use = power > 1e-6 * power.max()
    root = turn[:, use] / np.sqrt(power[use])
    kernel, value, own, own_weights = _similarities(positive + varied + negative + hard, landmarks, prior)
    scale = max(float(value.std()), 1e-6)
    x = np.hstack([kernel @ root, value[:, None] / scale, np.ones((len(kernel), 1))])
    n0 = len(negative) + 3 * len(hard)
    y = np.concatenate([np.ones(len(positive) + len(varied)), -np.ones(len(negative) + len(hard))])
    cost = 1000 * np.concatenate([np.full(len(positive), 1 / len(positive)), np.full(len(varied), 1 / max(1, len(varied))),
                                  np.full(len(negative), 3 / n0), np.full(len(hard), 9 / n0)])
    u = np.zeros(x.shape[1])
    ridge = np.full(len(u), 5.0)
    ridge[-2:] = 0.05, 1e-6
    for _ in range(30):
        active = y * (x @ u) < 1
        xa, ca = x[active], cost[active]
        new = np.linalg.solve(xa.T @ (xa * ca[:, None]) + np.diag(ridge), xa.T @ (ca * y[active]))
        if np.allclose(new, u, atol=1e-8):
            break
        u = new
    weight = prior.astype(np.float64) * (u[-2] / scale)
    for share, k, w in zip(root @ u[:-2], own, own_weights):
        np.add.at(weight, k, share * w)
    return weight.astype(np.float32), float(u[-1]), (x @ u)[:len(positive) + len(varied)]


def logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slopes and offset of Platt's curve with his smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    w[0], w[-1] = 1.0, log((n1 + 1) / (n0 + 1))
    ridge = 1e-2 * np.eye(len(w))

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - goal * z).sum() + w @ ridge @ w / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-12)[:, None]).T @ x + ridge, x.T @ (goal - p) - ridge @ w)
        while loss(w + step) > loss(w) and np.abs(step).max() >= 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def few_rows(batches):
    """The batches cut to ``ROWS`` rows, so that few texts are Python strings
    at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def hash_of(text: str) -> int:
    return crc32(text.encode("utf-8", "surrogatepass"))


def _presence(batches):
    """mapInArrow over (text, toxic): of each subsequence the number of clean
    and of toxic documents with it, a row per task."""
    import pyarrow as pa

    count = np.zeros((2, 1 << BITS), dtype=np.int32)
    for batch in few_rows(batches):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = np.zeros(1 << BITS, dtype=bool)
            text = reading(text)
            for a in range(0, len(text), PIECE):
                chars, _, _ = _packed([text[a:a + PIECE + _REACH]])
                n = len(chars) - _REACH
                for shape, k in hashed(chars, n):
                    seen[k[(chars[:n] > 0) & (chars[shape[-1]:shape[-1] + n] > 0)]] = True
            count[toxic] += seen
    yield pa.RecordBatch.from_arrays([pa.array([count.tobytes()], pa.binary())], names=["count"])


def _some(batches):
    """mapInArrow over texts of clean documents: a span of each width, at a
    place by hash."""
    import pyarrow as pa

    for batch in few_rows(batches):
        out = []
        for text in batch.column(0).to_pylist():
            text = reading(text)
            if text:
                at = hash_of(text)
                out += [(w, text[at // 7 ** i % len(text):][:w + _REACH]) for i, w in enumerate(WIDTHS)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.int32()),
                                          pa.array([t for _, t in out], pa.string())], names=["width", "span"])


def _highest(batches, weight, bias):
    """mapInArrow over (text, toxic): the highest span, its value, the evidence."""
    import pyarrow as pa

    for batch in few_rows(batches):
        got = [m or (None, 0.0, (None, None)) for m in measured(batch.column(0).to_pylist(), weight.value, bias, True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[2][0] for m in got], pa.int32()), pa.array([m[2][1] for m in got], pa.string()),
             pa.array([m[0] for m in got], pa.float64()), pa.array([m[1] for m in got], pa.float64()),
             batch.column(1)], names=["width", "span", "value", "evidence", "toxic"])


def curves(value: np.ndarray, evidence: np.ndarray, labels: np.ndarray, learnt: np.ndarray):
    """The curve of the value, and that of value and evidence. For the first,
    toxic documents have the values of the ``learnt`` spans, evenly taken, not
    of their highest ones alone: in a short text any of them may stand by itself."""
    alone = value.copy()
    alone[labels == 1] = np.quantile(learnt, (np.arange(int(labels.sum())) + 0.5) / labels.sum())
    return logistic(alone[:, None], labels), logistic(np.column_stack([value, np.log1p(evidence)]), labels)


def curved(value: np.ndarray, evidence: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    alone, counted = curve
    x = np.maximum(value * alone[0] + alone[1], value * counted[0] + np.log1p(evidence) * counted[1] + counted[2])
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _others(batches, weight, bias):
    """mapInArrow over texts of toxic documents: up to ``OTHERS`` narrow spans
    above 0 that start in different pairs of widths, so that the insults beside
    the highest one are learnt too."""
    import pyarrow as pa

    wide, over = 2 * WIDTHS[0], max(WIDTHS) + _REACH
    for batch in few_rows(batches):
        out = []
        for text in batch.column(0).to_pylist():
            text, found = reading(text), []
            for a in range(0, len(text), PIECE):
                chars, at, values = _spans([text[a:a + PIECE + over]], weight.value, bias)
                first = np.arange(0, len(at), wide)
                for i, high in zip(first, np.maximum.reduceat(values[0], first)):
                    if high > 0:
                        place = at[i + int(values[0][i:i + wide].argmax())]
                        found.append((float(high), _cut(chars[place:place + WIDTHS[0] + _REACH])))
            out += [t for _, t in sorted(found, reverse=True)[:OTHERS]]
        yield pa.RecordBatch.from_arrays([pa.array([WIDTHS[0]] * len(out), pa.int32()), pa.array(out, pa.string())],
                                         names=["width", "span"])


def _scores(texts: list, weight, bias: float, curve: tuple, lowest: float) -> np.ndarray:
    got = [m or (lowest, 0.0, None) for m in measured(texts, weight.value, bias)]
    return curved(np.array([m[0] for m in got]), np.array([m[1] for m in got]), curve)


def _score(batches, **model):
    """mapInArrow over (doc_id, held_out, text): the score."""
    import pyarrow as pa

    for batch in few_rows(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(_scores(batch.column(2).to_pylist(), **model))],
            names=["doc_id", "held_out", "score"])


def log_ratios(clean: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Log ratio of a subsequence's share of toxic documents to that of all,
    pulled to 0 where few documents have it."""
    return (np.log((toxic + SHRINK * share) / (clean + toxic + SHRINK)) - log(share)).astype(np.float32)


def train(labelled: DataFrame) -> dict | None:
    """``labelled`` has id, text and toxic (0 or 1), as many rows as
    ``training_rows`` takes at most. The model: broadcast weights, bias, curve
    and lowest value; None without both classes."""
    spark = labelled.sparkSession
    ship(spark)
    tasks = max(1, min(24, spark.sparkContext.defaultParallelism))      # of a bounded sample
    sample = materialise(labelled.select("text", "toxic").dropDuplicates().repartition(tasks), "toxicity-sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return None
    count = np.zeros((2, 1 << BITS))
    for r in sample.mapInArrow(_presence, "count binary").toLocalIterator():      # a row per task
        count += np.frombuffer(r["count"], dtype=np.int32).reshape(2, -1)
    prior = log_ratios(*count, n[1] / (n[0] + n[1]))
    by_hash = [F.crc32(F.col("span").cast("binary")), F.col("span"), F.col("width")]

    def spans(df):
        return [(r["width"], r["span"]) for r in df.select("width", "span").collect()]

    some = sample.where("toxic = 0").select("text").mapInArrow(_some, "width int, span string").distinct()
    negative = spans(some.orderBy(*by_hash).limit(NEGATIVES)) or [(WIDTHS[0], "")]
    weight, bias, hard = prior, 0.0, []
    for turn in range(TURNS + 1):
        shared = spark.sparkContext.broadcast(weight)         # 2^BITS floats
        top = materialise(sample.mapInArrow(
            partial(_highest, weight=shared, bias=bias),
            "width int, span string, value double, evidence double, toxic int"), "toxicity-spans")
        if turn == TURNS:
            break
        words = top.where("span is not null")
        positive = spans(words.where("toxic = 1").orderBy(*by_hash))
        if not positive:
            return None
        others = sample.where("toxic = 1").select("text").mapInArrow(
            partial(_others, weight=shared, bias=bias), "width int, span string").distinct()
        positive = sorted(set(positive) | set(spans(others.orderBy(*by_hash).limit(POSITIVES))),
                          key=lambda x: (hash_of(x[1]), x)) if turn else positive
        hard += spans(words.where("toxic = 0").orderBy(F.desc("value"), "span").limit(HARD))
        marks = _spread(positive, LANDMARKS // 2) + _spread(hard, LANDMARKS // 4)
        marks += _spread(negative, LANDMARKS - len(marks))
        weight, bias, learnt = fit(positive, variants(positive, VARIED), negative, hard, marks, prior)
    rows = top.select("value", "evidence", "toxic").toPandas()                    # a row per sampled document
    lowest = float(rows["value"].min())
    curve = curves(rows["value"].fillna(lowest).to_numpy(), rows["evidence"].to_numpy(),
                   rows["toxic"].to_numpy(dtype=np.float64), learnt)
    return {"weight": shared, "bias": bias, "curve": curve, "lowest": min(lowest, -1.0)}


def _spread(spans: list, n: int) -> list:
    """``n`` of the spans, evenly from first to last."""
    return spans if len(spans) <= n else [spans[i * len(spans) // n] for i in range(n)]


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and label of the documents to train on: labelled, outside the
    held-out quarter, at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` by the hash of
    the id. Only ids are shuffled; the chosen ones, whose number is bounded,
    are broadcast to the documents."""
    ids = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    marked = (labels.where("toxic in (0, 1) and doc_id is not null").where(crc_of_id(F.col("doc_id")) % 4 != 2)
              .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    marked = materialise(marked.join(ids, F.col("label_id") == F.col("id"), "left_semi"), "toxicity-labels")
    by_hash = [F.xxhash64("label_id"), F.col("label_id")]
    chosen = marked.where("toxic = 1").orderBy(*by_hash).limit(TOXIC_ROWS).union(
        marked.where("toxic = 0").orderBy(*by_hash).limit(CLEAN_ROWS))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "text", "toxic")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_of_id(F.col(id_col)) % 4 == 2).alias("held_out"),
                       F.col(text_col).alias("text"))
    model = train(training_rows(docs, labels, id_col, text_col))
    kind = rows.schema["doc_id"].dataType.simpleString()
    if model is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"))
    else:
        scored = rows.mapInArrow(partial(_score, **model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _keep(batches, column, threshold, **model):
    """mapInArrow over whole rows: those that aren't predicted toxic."""
    import pyarrow as pa

    for batch in few_rows(batches):
        yield batch.filter(pa.array(_scores(batch.column(column).to_pylist(), **model) < threshold))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic."""
    model = train(training_rows(docs, labels, id_col, text_col))
    if model is None:
        return docs
    return docs.mapInArrow(
        partial(_keep, column=docs.columns.index(text_col), threshold=threshold, **model), docs.schema)
