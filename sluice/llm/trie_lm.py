"""Language-model scores from an n-gram trie with Elias-Fano pointers.

Level 1 holds the words (sorted 64-bit hashes, counts); level 2 all pairs of
words, level 3 the triples seen at least twice (``LEAST``), sorted by (parent,
word): the word ids of each parent side by side, the smoothed probability
quantised to 16 bits, and monotone pointers from a parent to its first child in
Elias-Fano form. A look-up takes the parent's range from two pointers and searches the
word in it. Levels are cut into shards by key; a shard is a set of files in the
shared checkpoint folder, which workers memory-map: nothing of the model
passes through the driver but each shard's size and borders.

Probabilities are interpolated with absolute discounting: with D = n1 / (n1 +
2 n2) of a level (n1, n2: n-grams seen once, twice),

    p(w | h) = max(c(hw) - D, 0) / c(h) + rest(h) p(w | h')

over kept hw, rest(h) being what the kept ones leave; p(w) is add-one over the
vocabulary and one unknown word. Codes are rounded down, so no mass is gained.

Counting moves, per task and shard, one sorted run of distinct keys with their
counts. Shard borders are quantiles of the keys of a sample of about
``SAMPLE_DOCS`` documents, on (parent, word), so a frequent word is cut into several shards;
they only balance the work. N-grams that have to be seen twice are counted where
their parent was seen twice: the others can't be.

Nulls: a null text is empty (one token, the end); a null id counts as the empty
text in the split. Without training rows the scores are those of the one
unknown word (0). Empty tables give no rows; repeated rows count and are scored
each; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from functools import partial
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import crc_of_id, shared_folder, ship
from sluice.llm.wordhash import grouped, word_hashes

ORDER = 3
LEAST = {2: 1}       # times that n-grams of so many words are seen to be kept; others ``LEAST_LONG``
LEAST_LONG = 2
STEP = 4000.0        # codes per factor of ten
END = np.uint64(1)   # the hash that stands for the end of a text
FLUSH = 2_000_000    # keys that a counting task holds
SAMPLE_DOCS = 2000
SAMPLE_KEYS = 100    # keys of a sampled document


def encode(p: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities, rounded down (0 is 1, 65535 is 0)."""
    with np.errstate(divide="ignore"):
        return np.minimum(np.ceil(-np.log10(p) * STEP), 65535).astype(np.uint16)


_DECODED = np.append(10 ** (-np.arange(65535) / STEP), 0.0)


def pack_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits side by side, as bytes, with eight more to read
    whole words from any place."""
    out = [np.zeros(0, dtype=np.uint8)]
    for a in range(0, len(values), 1 << 16):                  # 2^16 numbers end at a whole byte
        some = values[a:a + (1 << 16), None].astype(np.uint64) >> np.arange(bits, dtype=np.uint64)
        out.append(np.packbits((some & np.uint64(1)).astype(np.uint8), axis=None, bitorder="little"))
    return np.concatenate([*out, np.zeros(8, dtype=np.uint8)])


def unpack_bits(data: np.ndarray, i: np.ndarray, bits: int) -> np.ndarray:
    """The i-th numbers of ``pack_bits``."""
    at = i * bits
    word = np.zeros(len(i), dtype=np.uint64)
    for b in range((bits + 14) // 8):
        word |= data[at // 8 + b].astype(np.uint64) << np.uint64(8 * b)
    return ((word >> (at % 8).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)


class EliasFano:
    """A monotone sequence below ``universe``: the low bits of each number, as
    many as the logarithm of universe / count, the high ones in unary, and the
    ones before each word. About two bits more than the low ones per number."""

    @staticmethod
    def build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        n = max(1, len(values))
        low = min(48, max(0, int(universe // n).bit_length() - 1))
        values = values.astype(np.uint64)
        at = (values >> np.uint64(low)).astype(np.int64) + np.arange(len(values))
        words = np.zeros((int(at[-1]) if len(at) else 0) // 64 + 1, dtype=np.uint64)
        np.bitwise_or.at(words, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
        before = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)
        return {"low": pack_bits(values, low), "bits": words, "before": before.astype(np.uint32),
                "shift": np.array([low], dtype=np.int64)}

    def __init__(self, parts: dict[str, np.ndarray], n: int):
        self.bits, self.before, self.shift = parts["bits"], parts["before"], int(parts["shift"][0])
        self.low = parts["low"]

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers: select of the i-th one, vectorised."""
        word = np.searchsorted(self.before, i, side="right") - 1
        left = (i - self.before[word]).astype(np.uint8)
        bits = self.bits[word]
        place = np.zeros(len(i), dtype=np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            mask = np.uint64((1 << half) - 1)
            ones = np.bitwise_count((bits >> place) & mask)
            up = ones <= left
            left = np.where(up, left - ones, left)
            place += np.where(up, np.uint64(half), np.uint64(0))
        out = (word * 64 + place.astype(np.int64) - i) << self.shift
        return out + unpack_bits(self.low, i, self.shift) if self.shift else out


def _save(folder: str, name: str, parts: dict[str, np.ndarray]) -> None:
    """Write the arrays; a repeated task replaces them by the same ones."""
    for key, a in parts.items():
        path = Path(folder, f"{name}.{key}.npy")
        draft = Path(folder, f"{name}.{key}.{uuid.uuid4().hex}.tmp")
        with draft.open("wb") as f:
            np.save(f, a)
        os.replace(draft, path)


def _open(folder: str, name: str, *keys: str) -> dict[str, np.ndarray]:
    return {k: np.load(Path(folder, f"{name}.{k}.npy"), mmap_mode="r") for k in keys}


class Words:
    """Level 1: hash -> id and count. Shards are equal ranges of the hash."""

    def __init__(self, folder: str, sizes: list[int]):
        self.parts = [_open(folder, f"1-{s}", "hash", "count") if n else None for s, n in enumerate(sizes)]
        self.first = np.cumsum([0, *sizes])
        self.shift = np.uint64(64 - (len(sizes) - 1).bit_length()) if len(sizes) > 1 else None

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, -1 if unknown; counts)."""
        keys, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        shard = (keys >> self.shift).astype(np.int64) if self.shift is not None else np.zeros(len(keys), dtype=np.int64)
        edge = np.searchsorted(shard, np.arange(len(self.parts) + 1))
        for s, part in enumerate(self.parts):
            a, b = edge[s], edge[s + 1]
            if a == b or part is None:
                continue
            at = np.searchsorted(part["hash"], keys[a:b])
            at[at == len(part["hash"])] = 0
            hit = part["hash"][at] == keys[a:b]
            ids[a:b][hit] = at[hit] + self.first[s]
            counts[a:b][hit] = part["count"][at[hit]]
        return ids[back], counts[back]


class Level:
    """A level k >= 2: (parent, word) -> node, probability; parent -> rest."""

    def __init__(self, folder: str, k: int, shards: list[dict], width: int):
        self.shards, self.width = [s for s in shards if s["n"]], width
        self.start = np.array([s["first"] for s in self.shards], dtype=np.int64)
        self.node = np.cumsum([0, *[s["n"] for s in self.shards]])
        self.parts, self.pointers = [], []
        for s in self.shards:
            name = f"{k}-{s['shard']}"
            self.parts.append(_open(folder, name, "word", "count", "code", "rest"))
            self.pointers.append(EliasFano(_open(folder, name, "low", "bits", "before", "shift"),
                                           s["last_parent"] - s["first_parent"] + 2))
        kept: dict[int, float] = {}            # shares of parents on a border between shards
        for s in self.shards:
            for p, share in s["borders"]:
                kept[p] = kept.get(p, 0.0) + share
        border = sorted(kept)
        self.border = np.array(border, dtype=np.int64)
        self.border_rest = np.array([max(0.0, 1 - kept[p]) for p in border])

    def find(self, parent: np.ndarray, word: np.ndarray, probability: bool = True):
        """(node or -1, its probability, or its count) of each pair."""
        node, value = np.full(len(parent), -1, dtype=np.int64), np.zeros(len(parent))
        if not self.shards or not len(parent):
            return node, value
        keys, back = np.unique(parent * self.width + word, return_inverse=True)
        edge = np.append(np.searchsorted(keys, self.start), len(keys))
        found, got = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys))
        for s, (shard, part, pointers) in enumerate(zip(self.shards, self.parts, self.pointers)):
            p, w = np.divmod(keys[edge[s]:edge[s + 1]], self.width)
            inside = np.flatnonzero(p <= shard["last_parent"])
            if not len(inside):
                continue
            p, w = p[inside] - shard["first_parent"], w[inside]
            lo, hi = pointers.get(p), pointers.get(p + 1)
            end = hi.copy()
            while True:                        # successor search in the context's own range
                open_ = lo < hi
                if not open_.any():
                    break
                mid = (lo + hi) // 2
                less = open_ & (part["word"][np.minimum(mid, shard["n"] - 1)] < w)
                lo = np.where(less, mid + 1, lo)
                hi = np.where(open_ & ~less, mid, hi)
            at = np.minimum(lo, shard["n"] - 1)
            hit = (lo < end) & (part["word"][at] == w)
            to = edge[s] + inside[hit]
            found[to] = at[hit] + self.node[s]
            got[to] = _DECODED[part["code"][at[hit]]] if probability else part["count"][at[hit]]
        return found[back], got[back]

    def rest(self, parent: np.ndarray) -> np.ndarray:
        out = np.ones(len(parent))
        for shard, part in zip(self.shards, self.parts):
            mine = (parent >= shard["first_parent"]) & (parent <= shard["last_parent"])
            if mine.any():
                out[mine] = _DECODED[part["rest"][parent[mine] - shard["first_parent"]]]
        if len(self.border):
            at = np.minimum(np.searchsorted(self.border, parent), len(self.border) - 1)
            hit = self.border[at] == parent
            out[hit] = self.border_rest[at[hit]]
        return out

    def count_of(self, node: np.ndarray) -> np.ndarray:
        out = np.zeros(len(node), dtype=np.int64)
        at = np.searchsorted(self.node, node, side="right") - 1
        for s, part in enumerate(self.parts):
            mine = at == s
            if mine.any():
                out[mine] = part["count"][node[mine] - self.node[s]]
        return out


class Model:
    """What the workers need to open the levels: plain numbers only."""

    def __init__(self, folder: str):
        self.folder, self.sizes, self.tokens, self.docs, self.levels = folder, [], 0, 0, []

    @property
    def types(self) -> int:
        return sum(self.sizes)

    @property
    def begin(self) -> int:        # the id that stands before a text
        return self.types

    @property
    def width(self) -> int:
        return self.types + 1


_models: dict = {}


def opened(model: Model) -> tuple[Words, list[Level]]:
    key = (model.folder, len(model.levels))
    if key not in _models:
        _models.clear()
        _models[key] = (Words(model.folder, model.sizes),
                        [Level(model.folder, k + 2, s, model.width) for k, s in enumerate(model.levels)])
    return _models[key]


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens with an end after each text, tokens per text)."""
    hashes, counts = word_hashes(texts)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def _texts(batches, column: int):
    import pyarrow as pa

    with np.errstate(over="ignore"):
        for batch in batches:
            texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
            for a, b in grouped(texts, 2 << 20):
                yield batch, a, b, texts[a:b]


def _runs(keys: list[np.ndarray], counts: list[np.ndarray]):
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _emit(keys: np.ndarray, counts: np.ndarray, shard_of):
    """Rows (shard, keys, counts): sorted keys as first differences."""
    import pandas as pd

    shard = shard_of(keys)
    edge = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist() + [len(keys)]
    rows = []
    for a, b in zip(edge, edge[1:]):
        step = np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8")
        rows.append((int(shard[a]), step.tobytes(), counts[a:b].astype("<u4").tobytes()))
    return pd.DataFrame(rows, columns=["shard", "keys", "counts"])


def _counted(pieces, shard_of):
    """Merge (keys, counts) pieces up to FLUSH keys and emit them by shard."""
    import pyarrow as pa

    keys, counts, n = [], [], 0
    schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def out():
        k, c = _runs(keys, counts)
        for batch in pa.Table.from_pandas(_emit(k, c, shard_of), schema, preserve_index=False).to_batches():
            yield batch

    for k, c in pieces:
        keys.append(k)
        counts.append(c)
        n += len(k)
        if n >= FLUSH:
            yield from out()
            keys, counts, n = [], [], 0
    if n:
        yield from out()


def _count_words(batches, shards: int):
    def pieces():
        for _, _, _, texts in _texts(batches, 0):
            k, c = np.unique(_tokens(texts)[0], return_counts=True)
            yield k, c.astype(np.uint32)

    shift = np.uint64(64 - (shards - 1).bit_length()) if shards > 1 else None
    yield from _counted(pieces(), lambda k: (k >> shift).astype(np.int64) if shift is not None
                        else np.zeros(len(k), dtype=np.int64))


def _contexts(texts: list[bytes], words: Words, levels: list[Level], begin: int, upto: int, least: int = 1):
    """ids, counts, tokens per text, and for each level the parent of each
    token (-1: not kept) and, below ``upto``, node and probability; with
    ``least``, the last level's nodes are those seen so often."""
    hashes, sizes = _tokens(texts)
    ids, counts = words.find(hashes)
    first = np.cumsum(sizes) - sizes
    parent = np.empty_like(ids)
    parent[1:] = ids[:-1]
    parent[first] = begin
    out = []
    for k, level in enumerate(levels[:upto]):
        use = np.flatnonzero((parent >= 0) & (ids >= 0))
        node, p = np.full(len(ids), -1, dtype=np.int64), np.zeros(len(ids))
        often = least > 1 and k == upto - 1
        node[use], p[use] = level.find(parent[use], ids[use], probability=not often)
        if often:
            node[p < least] = -1
        out.append((parent, node, p))
        parent = np.empty_like(node)
        parent[1:] = node[:-1]
        parent[first] = -1
    return ids, counts, sizes, out, parent


def least_of(k: int) -> int:
    return LEAST.get(k, LEAST_LONG)


def _parents(texts: list[bytes], words: Words, levels: list[Level], begin: int):
    """ids and parents of the next level's n-grams."""
    ids, _, _, _, parent = _contexts(texts, words, levels, begin, len(levels), least_of(len(levels) + 2))
    return ids, parent


def _count_grams(batches, model: Model, borders: np.ndarray):
    words, levels = opened(model)

    def pieces():
        for _, _, _, texts in _texts(batches, 0):
            ids, parent = _parents(texts, words, levels, model.begin)
            use = (parent >= 0) & (ids >= 0)
            k, c = np.unique((parent[use] * model.width + ids[use]).astype(np.uint64), return_counts=True)
            yield k, c.astype(np.uint32)

    yield from _counted(pieces(), lambda k: np.searchsorted(borders, k, side="right"))


def _sample_grams(batches, model: Model):
    """mapInArrow: some keys of sampled documents."""
    import pyarrow as pa

    words, levels = opened(model)
    for batch, _, _, texts in _texts(batches, 0):
        for t in texts:
            ids, parent = _parents([t], words, levels, model.begin)
            use = (parent >= 0) & (ids >= 0)
            keys = (parent[use] * model.width + ids[use])
            keys = keys[::max(1, len(keys) // SAMPLE_KEYS)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], names=["key"])


def _merged(rows):
    keys = [np.cumsum(np.frombuffer(b, dtype="<u8"), dtype=np.uint64) for b in rows["keys"]]
    return _runs(keys, [np.frombuffer(b, dtype="<u4").astype(np.int64) for b in rows["counts"]])


def _write_words(rows, folder: str):
    import pandas as pd

    shard = int(rows["shard"].iat[0])
    keys, counts = _merged(rows)
    _save(folder, f"1-{shard}", {"hash": keys, "count": counts})
    ends = counts[keys == END]
    return pd.DataFrame([{"shard": shard, "n": len(keys), "tokens": int(counts.sum()),
                          "docs": int(ends[0]) if len(ends) else 0}])


def _write_grams(rows, folder: str, k: int, width: int):
    """The kept n-grams of a shard, with pointers; and how many were seen
    once and twice."""
    import pandas as pd

    shard = int(rows["shard"].iat[0])
    keys, counts = _merged(rows)
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    keep = counts >= least_of(k)
    keys, counts = keys[keep].astype(np.int64), counts[keep]
    about = {"shard": shard, "n": len(keys), "once": once, "twice": twice, "first": -1, "first_parent": -1,
             "last_parent": -1}
    if len(keys):
        parent, word = np.divmod(keys, width)
        a, b = int(parent[0]), int(parent[-1])
        starts = np.searchsorted(parent, np.arange(a, b + 2))
        small = np.uint32 if counts.max() < 1 << 32 else np.int64
        _save(folder, f"{k}-{shard}", {"word": word.astype(np.uint32), "count": counts.astype(small)}
              | EliasFano.build(starts, len(keys) + 1))
        about |= {"first": int(keys[0]), "first_parent": a, "last_parent": b}
    return pd.DataFrame([about])


def _smooth(rows, model: Model, k: int, discount: float):
    """applyInPandas per shard: probabilities and rests."""
    import pandas as pd

    r = rows.iloc[0]
    folder, name = model.folder, f"{k}-{int(r['shard'])}"
    parts = _open(folder, name, "word", "count", "low", "bits", "before", "shift")
    a, b = int(r["first_parent"]), int(r["last_parent"])
    starts = EliasFano(parts, b - a + 2).get(np.arange(b - a + 2))
    parents = np.arange(a, b + 1)
    words, levels = opened(model)
    if k == 2:
        total = _word_counts(words, parents, model)
    else:
        total = levels[k - 3].count_of(parents)
    owner = np.repeat(np.arange(b - a + 1), np.diff(starts))
    p = (np.asarray(parts["count"], dtype=np.float64) - discount) / np.maximum(1, total)[owner]
    code = encode(p)
    share = np.bincount(owner, weights=p, minlength=b - a + 1)
    _save(folder, name, {"code": code, "rest": encode(np.clip(1 - share, 1e-15, 1))})
    return pd.DataFrame([{"shard": int(r["shard"]), "parents": [a, b] if b > a else [a],
                          "shares": [float(share[0]), float(share[-1])] if b > a else [float(share[0])]}])


def _word_counts(words: Words, ids: np.ndarray, model: Model) -> np.ndarray:
    out = np.full(len(ids), model.docs, dtype=np.int64)          # the begin's count
    at = np.searchsorted(words.first, ids, side="right") - 1
    for s, part in enumerate(words.parts):
        mine = (at == s) & (ids < model.types)
        if mine.any():
            out[mine] = part["count"][ids[mine] - words.first[s]]
    return out


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """The model of a DataFrame of one column, text."""
    spark = texts.sparkSession
    ship(spark)
    model = Model(shared_folder(spark, "trie"))
    os.makedirs(model.folder, exist_ok=True)
    shards = 1 << max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    run = "shard int, keys binary, counts binary"
    rows = (texts.mapInArrow(partial(_count_words, shards=shards), run).groupBy("shard")
            .applyInPandas(partial(_write_words, folder=model.folder), "shard int, n bigint, tokens bigint, docs bigint")
            .collect())                                                              # a row per shard
    sizes = {r["shard"]: r["n"] for r in rows}
    model.sizes = [sizes.get(s, 0) for s in range(shards)]
    model.tokens, model.docs = sum(r["tokens"] for r in rows), sum(r["docs"] for r in rows)
    for k in range(2, order + 1):
        if not model.tokens:
            break
        some = texts.sample(fraction=min(1.0, SAMPLE_DOCS / max(1, model.docs)), seed=k)     # sets borders only
        keys = some.mapInArrow(partial(_sample_grams, model=model), "key bigint").toPandas()["key"].to_numpy()
        borders = np.unique(np.quantile(keys, np.arange(1, shards) / shards, method="lower")).astype(np.uint64) \
            if len(keys) else np.empty(0, dtype=np.uint64)
        rows = (texts.mapInArrow(partial(_count_grams, model=model, borders=borders), run).groupBy("shard")
                .applyInPandas(partial(_write_grams, folder=model.folder, k=k, width=model.width),
                               "shard int, n bigint, once bigint, twice bigint, first bigint, first_parent bigint, "
                               "last_parent bigint").collect())
        once, twice = sum(r["once"] for r in rows), sum(r["twice"] for r in rows)
        level = sorted((r.asDict() for r in rows if r["n"]), key=lambda r: r["first"])
        if not level:
            break
        discount = min(1.0, once / (once + 2 * twice)) if once else 0.5
        borders_of = {r["shard"]: list(zip(r["parents"], r["shares"])) for r in spark.createDataFrame(
            [(r["shard"], r["first_parent"], r["last_parent"]) for r in level],
            "shard int, first_parent bigint, last_parent bigint").groupBy("shard").applyInPandas(
                partial(_smooth, model=model, k=k, discount=discount),
                "shard int, parents array<bigint>, shares array<double>").collect()}
        for r in level:
            r["borders"] = borders_of[r["shard"]]
        model.levels.append(level)
    return model


def _score(batches, model: Model):
    """mapInArrow over (doc_id, held_out, text)."""
    import pyarrow as pa

    words, levels = opened(model)
    n = model.tokens
    for batch, a, b, texts in _texts(batches, 2):
        ids, counts, sizes, found, _ = _contexts(texts, words, levels, model.begin, len(levels))
        base = (counts + 1) / (n + model.types + 1)
        p = base
        for level, (parent, _, own) in zip(levels, found):
            known = parent >= 0
            rest = np.ones(len(p))
            some, back = np.unique(parent[known], return_inverse=True)
            rest[known] = level.rest(some)[back]
            p = rest * p + own
        first = np.cumsum(sizes) - sizes
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sizes.astype(np.int64)),
             pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)),
             pa.array(np.full(b - a, n, dtype=np.int64)),
             pa.array(np.add.reduceat(np.log10(base), first)), pa.array(np.add.reduceat(np.log10(p), first))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_documents(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row, by a model of the rows that aren't held out."""
    held = crc_of_id(F.col(id_col)) % 7 == 2
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    model = train(rows.where(~F.col("held_out")).select("text"), order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_score, model=model),
                           f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                           "base_score double, score double")
