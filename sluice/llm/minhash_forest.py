"""Near-duplicate texts by an LSH forest over MinHash signatures.

Texts with equal sets of word shingles form one class. Each class enters
``TREES`` orders (trees): the signature, turned by ``BASE`` values per tree, is
its key. Classes that share the first ``BASE`` values of a key are a region of
that tree: two sets of similarity 0.8 share one in some tree with probability
1 - (1 - 0.8^3)^16 > 0.9999.

1. Every tree is sorted. A class's neighbours in the order have the longest
   common prefix with it, at whatever depth its region has. In
   ``NEIGHBOUR_TREES`` trees it meets them: in a region of thousands of near
   copies that gives each a few neighbours, not all pairs. The pairs are
   confirmed on the full shingle sets.
2. The confirmed links give components. Regions whose classes are all in one
   component need nothing more. In any other region of up to ``LIGHT``
   classes, each class outside its largest component meets all classes of
   other components.
3. Regions of more classes are joined where they share classes. Such a cluster
   is dealt into tiles by hash (bounded in shingles and in texts), and every two
   of its tiles meet: all pairs are compared on full sets in one sparse
   product, which returns stars that span the links, not pairs.
4. A cluster of more than ``DENSE`` tiles is too dense for its depth, as its
   products would grow with its square. Its classes, and no others, enter trees
   of the next depth of ``DEEPER``, as many as two sets of the similarity need
   to share a region of some but for ``MISS``; steps 2 and 3 are done in these
   regions, and so on. So depth follows density: texts that share a header part.
   What is dense at the last depth meets in tiles all the same.

Nothing is capped. A pair is missed only if it shares no region of some depth
that it has to reach: each time with a probability of about 1e-5 for pairs just
similar, less for others.

Only ids and keys are sorted; texts go to the pairs that ask for them.

Nulls: null texts and texts without words have an empty set (n_shingles 0) and
link with nothing; rows with a null id link with nothing and get a null
component. Rows of one id stay or go together; ids should be unique to a text
(else pairs are confirmed on the id's smallest text). Empty tables give no
rows; other columns are ignored, and ``first_of_each`` returns them as they
are.
"""

from __future__ import annotations

from functools import partial
from hashlib import blake2b
from math import ceil, log, log1p

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import checked_broadcast, materialise, ship
from sluice.llm.components import components, stars
from sluice.llm.wordhash import grouped, mix, word_hashes

SHINGLE = 5
PERCENT = 80
TREES = 16
BASE = 3
KEY = 8              # signature values in a key: BASE of the region, the rest to go deeper
DEEPER = (6, 10)     # depths of the trees that classes of denser regions enter
MISS = 1e-5          # of pairs just similar, those that share no region of such a depth
MOST_TREES = 128     # a depth that needs more (for low similarities) isn't entered
LIGHT = 64           # classes of a region that are paired one by one; fewer where there are more trees
DENSE = 16           # tiles of a cluster that meet without going deeper: each text moves that often at most
TILE = 100_000       # shingles in a tile of a larger region
TILE_TEXTS = 1024    # texts in a tile, on average, and multiplied at a time at most
COLUMNS = 4096       # shingles multiplied at a time
NEIGHBOUR_TREES = 4  # trees whose neighbours are compared first

_rng = np.random.default_rng(20240917)
_A = _rng.integers(1, 1 << 63, TREES * BASE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, TREES * BASE, dtype=np.uint64)
_MUL = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingles of each text."""
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    run = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        m = n - j
        if m > 0:
            run[:m] += mix(hashes[j:] * _MUL[j % len(_MUL)] + np.uint64(j))
    out, at = [], 0
    for c in counts.tolist():
        if c >= k:
            out.append(np.unique(run[at:at + c - k + 1]))
        elif c:
            whole = np.uint64(c)
            for j, h in enumerate(hashes[at:at + c]):
                whole = mix(np.array([h * _MUL[j % len(_MUL)] + whole], dtype=np.uint64))[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += c
    return out


def signature(values: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    """The 32-bit MinHash values of a set, one per multiplier of ``a``."""
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, 200_000 // len(a))
    for at in range(0, len(values), step):
        part = values[at:at + step, None]
        least = np.minimum(least, ((part * a + b) >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return least


def trees_of(depth: int, percent: int) -> int:
    """Trees of a depth such that two sets of the similarity share a region of
    at least one of them but for ``MISS``."""
    share = (percent / 100) ** depth
    return 1 if share >= 1 else ceil(log(MISS) / log1p(-share))


def _sign(batches, k: int):
    """mapInArrow over (doc_id, text): set size, digest of the set, signature."""
    import pyarrow as pa

    with np.errstate(over="ignore"):
        for batch in batches:
            ids, texts = batch.column(0), [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b in grouped(texts):
                sets = shingles(texts[a:b], k)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                              pa.binary()),
                     pa.array([signature(s).astype(">u4").tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "signature"])


def _keys(batches):
    """mapInArrow over (rep, n, signature): one row per tree."""
    import pyarrow as pa

    take = (np.arange(TREES)[:, None] * BASE + np.arange(KEY)) % (TREES * BASE)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        signatures = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=">u4").reshape(n, -1)
        keys = np.ascontiguousarray(signatures[:, take].reshape(n * TREES, KEY))
        data = pa.Array.from_buffers(pa.binary(4 * KEY), n * TREES, [None, pa.py_buffer(keys.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), data.cast(pa.binary()),
             pa.array(np.repeat(batch.column(0).to_numpy(), TREES)),
             pa.array(np.repeat(batch.column(1).to_numpy(), TREES))], names=["tree", "key", "rep", "n"])


def _near(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Set sizes that allow the similarity."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _regions(batches, percent: int):
    """mapInArrow over rows sorted by (tree, key): the members of regions with
    more than one class (and, as a region may go on in the next partition, the
    first and last row), each with its follower in the order or null."""
    import pyarrow as pa

    parts = [(b.column(0).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=">u4").reshape(-1, KEY),
              b.column(2).to_numpy(), b.column(3).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    tree, key, rep, n = (np.concatenate(x) for x in zip(*parts))
    same = (tree[1:] == tree[:-1]) & (key[1:, :BASE] == key[:-1, :BASE]).all(axis=1)
    keep = np.zeros(len(tree), dtype=bool)
    keep[1:] |= same
    keep[:-1] |= same
    keep[[0, -1]] = True
    close = np.append(same & _near(n[1:], n[:-1], percent), False)
    follower = np.append(rep[1:], 0)
    with np.errstate(over="ignore"):
        region = mix(mix(key[:, 0].astype(np.uint64) << np.uint64(32) | key[:, 1]) + (
            key[:, 2].astype(np.uint64) << np.uint64(8) | tree.astype(np.uint64))).view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(tree[keep]), pa.array(region[keep]), pa.array(rep[keep]), pa.array(n[keep]),
         pa.array(follower[keep], mask=~close[keep])], names=["tree", "region", "rep", "n", "follower"])


def _deep(batches, k: int, depth: int, trees: int):
    """mapInArrow over (rep, text): its region in every tree of a depth."""
    import pyarrow as pa

    rng = np.random.default_rng([20240917, depth])
    a = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64)
    with np.errstate(over="ignore"):
        start = mix(np.arange(trees, dtype=np.uint64) + np.uint64(depth << 32))
        for batch in batches:
            reps, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary()).to_pylist()
            for x, y in grouped(texts):
                sets = shingles(texts[x:y], k)
                least = np.stack([signature(s, a, b) for s in sets]).reshape(-1, trees, depth).astype(np.uint64)
                region = np.tile(start, (len(sets), 1))
                for j in range(depth):
                    region = mix(region + least[:, :, j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.reshape(-1).view(np.int64)), pa.array(np.repeat(reps[x:y], trees)),
                     pa.array(np.repeat(np.array([len(s) for s in sets], dtype=np.int64), trees))],
                    names=["region", "rep", "n"])


def _confirm(batches, k: int, percent: int):
    """mapInArrow over (a, b, text_a, text_b): the pairs that are similar."""
    import pyarrow as pa

    with np.errstate(over="ignore"):
        for batch in batches:
            x, y = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            keep = []
            for a, b in grouped(x):
                sets = shingles(x[a:b] + y[a:b], k)
                for s, t in zip(sets[:b - a], sets[b - a:]):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))


def _similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the similar pairs of two lists of sets, by the product
    of their shingle matrices (shingles of one set alone don't count)."""
    sets = [*left, *right]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = len(left)
    both = np.zeros((n, len(right)), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        both += m[:n] @ m[n:].T
    union = size[:n, None] + size[None, n:] - both
    return np.nonzero(100 * both.astype(np.float64) >= percent * union)


def _tiles_meet(batches, k: int, percent: int):
    """mapInPandas over pairs of tiles: stars that span the similar pairs."""
    import pandas as pd

    with np.errstate(over="ignore"):
        for pairs in batches:
            for r in pairs.itertuples(index=False):
                ids, sets = [], []
                for docs in (r.docs, r.docs_r):
                    ids.append(np.array([d["id"] for d in docs], dtype=np.int64))
                    sets.append([s for a, b in grouped([d["text"].encode() for d in docs])
                                 for s in shingles([d["text"].encode() for d in docs[a:b]], k)])
                for x in range(0, len(sets[0]), TILE_TEXTS):
                    for y in range(0, len(sets[1]), TILE_TEXTS):
                        i, j = _similar(sets[0][x:x + TILE_TEXTS], sets[1][y:y + TILE_TEXTS], percent)
                        u, v = stars(ids[0][x + i], ids[1][y + j])
                        yield pd.DataFrame({"a": u, "b": v})


def _dealt(member: DataFrame) -> DataFrame:
    """rep, component, tile, tiles: a component's members dealt by hash into
    tiles of about ``TILE`` shingles and ``TILE_TEXTS`` texts at most."""
    total = member.groupBy("component").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("texts")).select(
        F.col("component").alias("c"),
        F.greatest(F.ceil(F.col("total") / TILE), F.ceil(F.col("texts") / TILE_TEXTS)).alias("tiles"))
    return member.join(total, F.col("component") == F.col("c")).select(
        "rep", "component", F.pmod(F.xxhash64("rep"), F.col("tiles")).alias("tile"), "tiles")


def _clusters(regions: DataFrame) -> DataFrame:
    """The classes of large regions, dealt into the tiles of their cluster."""
    first = regions.groupBy("region").agg(F.min("rep").alias("first"))
    spokes = regions.join(first.withColumnRenamed("region", "g"), F.col("region") == F.col("g")).select(
        F.col("first").alias("a"), F.col("rep").alias("b"))
    cluster = materialise(components(spokes), "clusters")
    member = regions.groupBy("rep").agg(F.max("n").alias("n"))
    member = member.join(cluster, F.col("rep") == F.col("node")).select("rep", "n", "component")
    return materialise(_dealt(member), "dealt")


def _clusters_met(dealt: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that span all similar pairs of each cluster."""
    some = texts.join(checked_broadcast(dealt.select("rep"), 16), F.col("id") == F.col("rep"), "left_semi")
    some = some.groupBy("id").agg(F.min("text").alias("text"))
    tiles = materialise(
        dealt.join(some, F.col("rep") == F.col("id")).groupBy("component", "tile").agg(
            F.collect_list(F.struct("id", "text")).alias("docs")), "text-tiles")
    about = tiles.select("component", "tile")
    pairs = about.join(about.select(F.col("component").alias("component_r"), F.col("tile").alias("tile_r")),
                       (F.col("component") == F.col("component_r")) & (F.col("tile") <= F.col("tile_r")))
    left = tiles.select(F.col("component").alias("c"), F.col("tile").alias("t"), "docs")
    right = tiles.select(F.col("component").alias("c_r"), F.col("tile").alias("t_r"), F.col("docs").alias("docs_r"))
    return materialise(
        pairs.join(left, (F.col("component") == F.col("c")) & (F.col("tile") == F.col("t")))
        .join(right, (F.col("component_r") == F.col("c_r")) & (F.col("tile_r") == F.col("t_r")))
        .select("docs", "docs_r")
        .mapInPandas(partial(_tiles_meet, k=k, percent=percent), "a bigint, b bigint"), "cluster-links")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the (distinct) pairs whose full sets are similar. Only the
    texts that take part are moved."""
    pairs = materialise(pairs, "candidates")
    wanted = materialise(pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct(), "wanted")
    some = texts.join(checked_broadcast(wanted, 16), F.col("id") == F.col("w"), "left_semi")
    some = materialise(some.groupBy("id").agg(F.min("text").alias("text")), "wanted-texts")
    left = some.select(F.col("id").alias("ia"), F.col("text").alias("text_a"))
    right = some.select(F.col("id").alias("ib"), F.col("text").alias("text_b"))
    return materialise(
        pairs.join(left, F.col("a") == F.col("ia")).join(right, F.col("b") == F.col("ib"))
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(partial(_confirm, k=k, percent=percent), "a bigint, b bigint"), "confirmed")


def _across(regions: DataFrame, comps: DataFrame, percent: int, light: int) -> tuple[DataFrame, DataFrame]:
    """Regions with several components: of the light ones the pairs between
    components (classes outside the largest meet the others), and the members
    of the others."""
    member = materialise(regions.select("region", "rep", "n").join(
        comps.select(F.col("node").alias("m"), F.col("component").alias("c")), F.col("rep") == F.col("m"), "left")
        .select("region", "rep", "n", F.coalesce("c", "rep").alias("c")), "members")
    mixed = materialise(member.groupBy("region", "c").agg(F.count(F.lit(1)).alias("size")).groupBy("region").agg(
        F.max(F.struct("size", "c"))["c"].alias("largest"), F.count(F.lit(1)).alias("parts"),
        F.sum("size").alias("size")).where("parts > 1").select(F.col("region").alias("g"), "largest", "size"),
        "mixed")
    every = materialise(member.join(checked_broadcast(mixed, 64), F.col("region") == F.col("g")).drop("g"),
                        "mixed-regions")
    member = every.where(F.col("size") <= light)
    few = member.where("c <> largest").select(F.col("region").alias("s"), F.col("rep").alias("rep2"),
                                              F.col("n").alias("n2"), F.col("c").alias("c2"))
    met = member.join(few, (F.col("region") == F.col("s")) & (F.col("c") != F.col("c2"))
                      & ((F.col("c") == F.col("largest")) | (F.col("rep") < F.col("rep2")))
                      & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
    pairs = met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
    return pairs, every.where(F.col("size") > light).select("region", "rep", "n")


def _deeper(dense: DataFrame, texts: DataFrame, k: int, depth: int, trees: int) -> DataFrame:
    """region, rep, n of the dense regions' classes in the trees of a depth."""
    wanted = materialise(dense.select(F.col("rep").alias("w")).distinct(), "dense")
    some = texts.join(checked_broadcast(wanted, 16), F.col("id") == F.col("w"), "left_semi")
    return materialise(
        some.groupBy("id").agg(F.min("text").alias("text")).mapInArrow(
            partial(_deep, k=k, depth=depth, trees=trees), "region bigint, rep bigint, n bigint"), f"depth-{depth}")


def near_duplicate_texts(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = materialise(source.mapInArrow(
        partial(_sign, k=shingle), "doc_id bigint, n_shingles bigint, digest binary, signature binary"), "signed")
    classes = materialise(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"),
            F.any_value("signature").alias("signature")), "classes")
    keys = classes.select("rep", "n", "signature").mapInArrow(_keys, "tree int, key binary, rep bigint, n bigint")
    regions = materialise(
        keys.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep").mapInArrow(
            partial(_regions, percent=percent), "tree int, region bigint, rep bigint, n bigint, follower bigint"),
        "regions")
    texts = source.where("id is not null and text is not null")
    near = regions.where(F.col("follower").isNotNull() & (F.col("tree") < NEIGHBOUR_TREES)).select(
        F.least("rep", "follower").alias("a"), F.greatest("rep", "follower").alias("b")).where("a < b").distinct()
    comps = materialise(components(_confirmed(near, texts, shingle, percent)), "components")
    pairs, large = _across(regions, comps, percent, LIGHT)
    links = _confirmed(pairs, texts, shingle, percent)
    depths = [d for d in DEEPER if trees_of(d, percent) <= MOST_TREES]
    while not large.isEmpty():
        dealt = _clusters(large)
        few = dealt.where(F.col("tiles") <= DENSE) if depths else dealt
        links = links.union(_clusters_met(few, texts, shingle, percent))
        dense = dealt.where(F.col("tiles") > DENSE)
        if not depths or dense.isEmpty():
            break
        depth = depths.pop(0)
        trees = trees_of(depth, percent)
        comps = materialise(_merged(comps, links), "components")
        pairs, large = _across(_deeper(dense, texts, shingle, depth, trees), comps, percent,
                               max(2, LIGHT * TREES // trees))
        links = _confirmed(pairs, texts, shingle, percent)
    by_class = _merged(comps, links)
    to_class = classes.select(F.col("digest").alias("d"), "rep").join(
        by_class, F.col("rep") == F.col("node"), "left").select(
        "d", F.coalesce("component", "rep").alias("component"))
    able = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    linked = signed.where(able).join(to_class, F.col("digest") == F.col("d"))
    return linked.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                         (F.col("doc_id") == F.col("component")).alias("kept")).union(
        signed.where(~able).select("doc_id", "n_shingles", "doc_id", F.col("doc_id").isNotNull()))


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links between their nodes."""
    a = comps.select(F.col("node").alias("na"), F.col("component").alias("ca"))
    b = comps.select(F.col("node").alias("nb"), F.col("component").alias("cb"))
    lifted = links.join(a, F.col("a") == F.col("na"), "left").join(b, F.col("b") == F.col("nb"), "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    more = materialise(components(lifted), "components")
    moved = more.select(F.col("node").alias("n"), F.col("component").alias("to"))
    old = comps.join(moved, F.col("component") == F.col("n"), "left").select(
        "node", F.coalesce("to", "component").alias("component"))
    new = more.join(comps.select(F.col("node").alias("known")), F.col("node") == F.col("known"), "left_anti")
    return old.union(new)


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that are near copies of another
    document with a smaller id; rows with a null id stay."""
    found = near_duplicate_texts(docs, shingle, percent, id_col, text_col)
    gone = found.where("not kept").select(F.col("doc_id").alias("gone__")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("gone__"), "left_anti")
