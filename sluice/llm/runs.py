"""Periodic runs of words: stretches that repeat with a period.

A run is a stretch of words with smallest period q, of at least ``least`` words
and ``exponent`` periods, that no neighbouring word extends. On the diagonal of
lag q (word i beside word i - q) it is one stretch of matches.

The words of a text are read in order. Each word's earlier occurrences give
lags; a lag that was active at the word before has its match length
incremented, a new one starts, and one that is missing has ended: its stretch
is emitted at once if it is long enough.

The diagonals are kept sparse without losing a run. Let k be the power of two
with k/2 < q <= k. In a run the k words up to a place occur last exactly q words
before (a nearer place would give a smaller period), and so they do at every
place of it after the first q + k - 1 words; outside, the diagonal doesn't
match for k words. So a place needs to look, for each k, at one earlier
occurrence only: the last one of the k words that end there, and it counts if
its lag lies between k/2 and k. A stretch of such lags stands for as many
matches and k - 1 more before them. Grams of k words are numbered by pairs of
halves, exactly, and only words whose gram occurs twice in the text go on to
the next k, which in ordinary texts soon leaves none. Time and memory are about
n log n at most for n words, also for texts of one word repeated.

``collapse`` leaves out what any run repeats: its words after the first period.

Nulls: a null text has no words, a null id is kept. Empty tables give no rows,
repeated rows one each; other columns are ignored. A text is read whole by one
task, with about 100 bytes of memory for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ship

LEAST = 6            # words of a run
EXPONENT = 4         # periods of a run, at least 3
GROUP = 1 << 20      # bytes of texts whose lags are looked for together


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, different in each text; and the texts' starts."""
    numbers, starts, base = [], [0], 0
    for words in texts:
        known: dict[bytes, int] = {}
        own = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
        numbers.append(own + base)
        base += len(known)
        starts.append(starts[-1] + len(words))
    return np.concatenate(numbers) if numbers else np.zeros(0, np.int64), np.array(starts)


def sparse_lags(word: np.ndarray, longest: int, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) by place, then lag: for each k the lag to the last
    occurrence of the k words that end at the place, if in (k/2, k]. ``longest``
    is the most words of one text."""
    n, k = len(word), 1
    same = np.flatnonzero(word[1:] == word[:-1]) + 1
    found, lags = [same], [np.ones(len(same), dtype=np.int64)]
    gram = word + 1                                   # 0: occurs once
    gram[np.bincount(word, minlength=1)[word] < 2] = 0
    while k < longest // exponent:                    # the next k's lags are longer than k
        place = np.flatnonzero(gram)
        place = place[place >= k]
        place = place[gram[place - k] > 0]
        if not len(place):
            break
        pair = gram[place - k] * (int(gram.max()) + 1) + gram[place]
        k *= 2
        order = np.argsort(pair, kind="stable")       # equal grams side by side, by place
        at, pair = place[order], pair[order]
        again = pair[1:] == pair[:-1]
        lag = at[1:] - at[:-1]
        hit = again & (lag <= k) & (2 * lag > k)
        found.append(at[1:][hit])
        lags.append(lag[hit])
        twice = np.append(again, False) | np.append(False, again)
        number = 1 + np.cumsum(np.append(False, ~again))
        gram = np.zeros(n, dtype=np.int64)
        gram[at[twice]] = number[twice]
    place, lag = np.concatenate(found), np.concatenate(lags)
    order = np.lexsort((lag, place))
    return place[order], lag[order]


def runs_of(place: list[int], lag: list[int], least: int = LEAST,
            exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period, of one text's lags."""
    runs = []

    def ended(lags: dict[int, int], last: int) -> None:
        for q, matches in lags.items():
            length = matches + q
            if length >= least and length >= exponent * q:
                runs.append((last + 1 - length, length, q))

    active: dict[int, int] = {}                       # lag -> match length up to the place before
    before, i, n = -1, 0, len(place)
    while i < n:
        here, going = place[i], {}
        if here != before + 1:
            ended(active, before)
            active = {}
        while i < n and place[i] == here:
            q = lag[i]
            matches = active.pop(q, 0)
            going[q] = matches + 1 if matches else 1 << (q - 1).bit_length()
            i += 1
        ended(active, before)
        active, before = going, here
    ended(active, before)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, with a space between."""
    if not runs:
        return b" ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = bytes(length - period)
    return b" ".join(compress(words, keep))


def runs_of_texts(texts: list[bytes], least: int = LEAST,
                  exponent: int = EXPONENT) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """The runs and the collapsed text of each text."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP:
            yield from _grouped(group, least, exponent)
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield from _grouped(group, least, exponent)


def _grouped(texts: list[bytes], least: int, exponent: int):
    split = [t.split() for t in texts]                # bytes split at ASCII white space only
    word, starts = numbered(split)
    place, lag = sparse_lags(word, max(map(len, split)), exponent)
    parts = np.searchsorted(place, starts)
    for i, words in enumerate(split):
        part = slice(parts[i], parts[i + 1])
        runs = runs_of((place[part] - starts[i]).tolist(), lag[part].tolist(), least, exponent)
        yield runs, collapse(words, runs)


def _find(batches, least: int, exponent: int):
    """mapInArrow over (doc_id, text): doc_id, runs, collapsed."""
    import pyarrow as pa

    rows = 500
    for whole in batches:
        for first in range(0, whole.num_rows, rows):
            batch = whole.slice(first, rows)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            runs, collapsed = zip(*runs_of_texts(texts, least, exponent))
            flat = np.array([r for of in runs for r in of], dtype=np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)],
                                               names=["start", "length", "period"])
            ends = np.concatenate([[0], np.cumsum([len(of) for of in runs])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length and period in words, by start, then period)
    and the collapsed text of each row."""
    if exponent < 3:
        raise ValueError("runs of fewer than three periods aren't found by their diagonals' last occurrences")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_find, least=least, exponent=exponent),
        f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
