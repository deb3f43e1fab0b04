"""Near-duplicate texts, language-model scores and toxicity."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.fixtures import DOC, doc_rows, documents, linked_components, rows_of
from sluice.llm import minhash_forest, toxicity, trie_lm
from sluice.llm.components import components, stars
from sluice.llm.wordhash import word_hashes


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w.decode() for w in low(text).encode().split()]


def test_word_hashes():
    texts = [t or "" for _, t, *_ in doc_rows()] + ["a" * 3000 + " b", " lead", "trail "]
    with np.errstate(over="ignore"):
        hashes, counts = word_hashes([t.encode() for t in texts])
    flat = [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    seen = {}
    for w, h in zip(flat, hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rnd = random.Random(seed)
    n = 120
    pairs = [(i, i + 1) for i in range(60)] if seed == 0 else [
        (rnd.randrange(n), rnd.randrange(n)) for _ in range(rnd.choice([10, 70, 400]))]
    want = {i: c for i, c in enumerate(linked_components(n, pairs)) if any(i in p and p[0] != p[1] for p in pairs)}
    got = components(spark.createDataFrame(pairs, "a long, b long").repartition(5))
    assert {r.node: r.component for r in got.collect()} == want
    a, b = stars(*(np.array(x) for x in zip(*pairs)))
    lowest = linked_components(n, pairs)
    assert all(lowest[x] == y for x, y in zip(a.tolist(), b.tolist()))


def brute_near(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    ids = sorted(sets)
    pairs = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    at = {i: n for n, i in enumerate(ids)}
    lowest = linked_components(len(ids), [(at[a], at[b]) for a, b in pairs])
    return sorted((i, len(sets[i]), ids[lowest[at[i]]], ids[lowest[at[i]]] == i) for i in ids)


@pytest.mark.parametrize("light, dense", [(64, 16), (3, 16), (3, 2)])
def test_near_duplicates_equal_brute_force(spark, light, dense, monkeypatch):
    """Copies of a base with few and many changes, so that some link only
    through others; also with every larger region dealt into tiles, or gone deeper first."""
    monkeypatch.setattr(minhash_forest, "LIGHT", light)
    monkeypatch.setattr(minhash_forest, "TILE", 900)
    monkeypatch.setattr(minhash_forest, "DENSE", dense)
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = [(i, t) for i, t, *_ in doc_rows() if i is not None and i != 14]
    for base in range(6):
        text = rnd.choices(vocabulary, k=90)
        for _ in range(25):
            changed = list(text)
            for _ in range(rnd.choice([0, 1, 2, 3, 5, 8])):
                changed[rnd.randrange(len(changed))] = rnd.choice(vocabulary)
            rows.append((100 + len(rows), " ".join(changed)))
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    for k in (4, 5):
        got = sorted(map(tuple, minhash_forest.near_duplicate_texts(docs, shingle=k).collect()))
        assert got == brute_near(rows, k, 80)


def test_texts_under_one_header_part_at_greater_depths(spark, monkeypatch):
    """Texts that share two thirds of their words are dense at the first depth;
    the next ones part them, and their near copies are found all the same."""
    rnd = random.Random(8)
    header = [f"h{i}" for i in range(60)]
    rows = []
    for i in range(0, 600, 2):
        own = [f"w{rnd.randrange(10**6)}" for _ in range(30)]
        rows += [(i, " ".join(header + own)), (i + 1, " ".join(header + own[:-2] + [f"z{i}", "end"]))]
    monkeypatch.setattr(minhash_forest, "TILE", 9000)
    monkeypatch.setattr(minhash_forest, "DENSE", 2)
    dense, tiled = [], []
    deeper, met = minhash_forest._deeper, minhash_forest._clusters_met

    def count(seen, members):
        seen.append(members.select("rep").distinct().count())
        return members

    monkeypatch.setattr(minhash_forest, "_deeper", lambda m, *a: deeper(count(dense, m), *a))
    monkeypatch.setattr(minhash_forest, "_clusters_met", lambda m, *a: met(count(tiled, m), *a))
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    got = sorted(map(tuple, minhash_forest.near_duplicate_texts(docs, shingle=4).collect()))
    assert got == brute_near(rows, 4, 80) and {r[2] for r in got} == set(range(0, 600, 2))
    assert dense[0] > 500 and sum(tiled) < 400, (dense, tiled)


def test_trees_of_a_depth():
    for depth in minhash_forest.DEEPER:
        trees = minhash_forest.trees_of(depth, 80)
        assert trees <= minhash_forest.MOST_TREES and (1 - 0.8 ** depth) ** trees <= minhash_forest.MISS
    assert minhash_forest.trees_of(6, 100) == 1 and minhash_forest.trees_of(10, 50) > minhash_forest.MOST_TREES
    import pyarrow as pa

    rnd = random.Random(1)
    own = [[f"w{rnd.randrange(1000)}" for _ in range(50)] for _ in range(3)]
    texts = [" ".join(w) for w in (own[0], own[0], own[0][:-1] + ["x"], own[1], own[2])]
    batch = pa.RecordBatch.from_pydict({"rep": pa.array(range(5), pa.int64()), "text": texts})
    got = pa.Table.from_batches(minhash_forest._deep([batch], 4, 6, 38)).to_pandas()
    by = {i: set(g["region"]) for i, g in got.groupby("rep")}
    assert got.groupby("rep")["n"].first().tolist() == [47, 47, 47, 47, 47] and len(by[0]) == 38
    assert by[0] == by[1] and by[0] & by[2] and not by[0] & by[3] and not by[3] & by[4]


def test_near_duplicates_odd_rows(spark):
    got = minhash_forest.near_duplicate_texts(documents(spark), shingle=4).collect()
    assert len(got) == len(doc_rows())
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == by[2].component_id == 0 and by[4].n_shingles == by[6].n_shingles == 0
    assert by[8].component_id == by[14].component_id == 7 and by[None].component_id is None
    assert minhash_forest.near_duplicate_texts(documents(spark).limit(0)).count() == 0
    kept = minhash_forest.first_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert {r.doc_id for r in kept.collect()} == {0, 4, 5, 6, 7, 9, 10, 12, None}


def brute_lm(rows):
    """The interpolated model with plain dictionaries."""
    tok = [(i, words(t) + ["</s>"]) for i, t in rows]
    train = [t for i, t in tok if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c1 = Counter(w for t in train for w in t)
    n, v = sum(c1.values()), len(c1)
    c2 = Counter(b for t in train for b in zip(["<s>", *t], t))
    k2 = c2
    c3 = Counter(b for t in train for b in zip(["<s>", *t], t, t[1:]) if c2[b[:2]] >= 2)
    k3 = {g: c for g, c in c3.items() if c >= 2}

    def discount(counts):
        once, twice = (sum(x == k for x in counts.values()) for k in (1, 2))
        return min(1.0, once / (once + 2 * twice)) if once else 0.5

    d2, d3 = discount(c2), discount(c3)
    total = c1 + Counter({"<s>": len(train)})
    s2, s3 = defaultdict(float), defaultdict(float)
    for g, c in k2.items():
        s2[g[0]] += (c - d2) / total[g[0]]
    for g, c in k3.items():
        s3[g[:2]] += (c - d3) / k2[g[:2]]
    out = []
    for i, t in tok:
        base = score = 0.0
        before = [None, "<s>"]
        for w in t:
            p = (c1[w] + 1) / (n + v + 1)
            base += math.log10(p)
            u, h = before
            p = (1 - s2[h]) * p + (max(0, k2[h, w] - d2) / total[h] if (h, w) in k2 else 0)
            if (u, h) in k2:
                p = (1 - s3[u, h]) * p + ((k3[u, h, w] - d3) / k2[u, h] if (u, h, w) in k3 else 0)
            score += math.log10(max(p, 1e-300))
            before = [h, w]
        out.append((i, len(t), sum(c1[w] > 0 for w in t), n, base, score))
    return out


def test_trie_scores_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, t) for i, t, *_ in doc_rows()] + [
        (100 + i, " ".join(rnd.choices("the of and cat dog runs Fast slow , .".split(), k=rnd.randrange(60)))) for i in range(120)]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(4)
    got = defaultdict(list)
    for r in trie_lm.score_documents(docs).collect():
        got[r.doc_id].append(r)
    for i, n, known, total, base, score in brute_lm(rows):
        r = got[i].pop()
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert abs(r.score - score) < 0.003 * n + 1e-6
    assert not any(got.values())
    held = [(base, score) for i, *_, base, score in brute_lm(rows) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(s for _, s in held) > sum(b for b, _ in held)


def test_trie_without_rows_or_training(spark):
    assert trie_lm.score_documents(spark.createDataFrame([], DOC)).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = trie_lm.score_documents(spark.createDataFrame([(held, "a b", "en", "s", 1)], DOC)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("values, universe", [([0], 1), ([0, 0, 5, 5, 9], 10), (sorted(random.Random(1).choices(range(1 << 40), k=999)), 1 << 40),
                                               (list(range(5000)), 5000),
                                               *[(sorted(random.Random(r).choices(range(70000 * r), k=70000)), 70000 * r)
                                                 for r in (2, 100, 200, 300)]])
def test_elias_fano(values, universe):
    parts = trie_lm.EliasFano.build(np.array(values), universe)
    if len(values) > 5000:       # low bits and two more, and a word's count
        bits = 8 * sum(parts[k].nbytes for k in ("low", "bits", "before")) / len(values)
        assert bits < math.log2(universe / len(values)) + 4
    assert trie_lm.EliasFano(parts, len(values)).get(np.arange(len(values))).tolist() == values


def test_tiles_of_many_short_texts(spark, monkeypatch):
    member = spark.range(6000).select(F.col("id").alias("rep"), F.lit(2).cast("long").alias("n"),
                                      F.lit(0).cast("long").alias("component"))
    tiles = minhash_forest._dealt(member).groupBy("component", "tile").count().collect()
    assert sum(r["count"] for r in tiles) == 6000 and max(r["count"] for r in tiles) < 1300
    sizes, similar = [], minhash_forest._similar
    monkeypatch.setattr(minhash_forest, "_similar",
                        lambda a, b, p: sizes.append(max(len(a), len(b))) or similar(a, b, p))
    import pandas as pd

    docs = [{"id": i, "text": f"all rights reserved by x{i // 2}"} for i in range(3000)]
    got = pd.concat(minhash_forest._tiles_meet([pd.DataFrame([{"docs": docs, "docs_r": docs[::-1]}])], 4, 80))
    assert max(sizes) <= 1024
    links = {(min(p), max(p)) for p in zip(got["a"].tolist(), got["b"].tolist()) if p[0] != p[1]}
    assert links == {(i, i + 1) for i in range(0, 3000, 2)}


def toxic_tables(spark, n=900, seed=2):
    rnd = random.Random(seed)
    syllables = "ta ri mo len ka su per vi do na fe lor".split()
    word = lambda: "".join(rnd.choices(syllables, k=rnd.randint(1, 3)))
    docs, labels, truth = [], [], {}
    for i in range(n):
        w = [word() for _ in range(40)]
        if toxic := i % 6 == 0:
            for _ in range(3):
                w[rnd.randrange(40)] = rnd.choice(["blockhead", "nitwit", "dunderpate", "scoundrel"])
        docs.append((i, " ".join(w), "en", "s", 1))
        truth[i] = int(toxic)
        labels.append((i, 1, int(toxic)))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_toxicity_on_held_out_rows_and_obfuscations(spark):
    docs, labels, truth = toxic_tables(spark)
    extra = [(10_000, "talen nitxwit mori", "en", "s", 1), (10_001, "kasu bloockhead", "en", "s", 1),
             (10_002, "n i t w i t", "en", "s", 1), (10_003, "per sco-undrel", "en", "s", 1)]
    more = [(20_000, None, None, None, None), (20_001, "", "en", "s", 0), (20_002, "x" * 9000, "en", "s", 1),
            (None, "mori talen", "en", "s", 1)]
    got = {r.doc_id: r for r in toxicity.toxicity_scores(documents(spark, docs + extra + more), labels).collect()}
    assert len(got) == len(docs) + len(extra) + len(more)
    held = [i for i in truth if got[i].held_out]
    assert held and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert all(got[i].predicted == truth[i] for i in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(got[i].predicted for i, *_ in extra)
    assert not any(got[i].predicted for i, *_ in more)
    # a held-out label never matters
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(documents(spark, docs), flipped).collect()}
    assert all(again[i] == pytest.approx(got[i].score, abs=1e-6) for i in truth)


def test_toxicity_of_rare_inflections(spark):
    rnd = random.Random(8)
    syllables = "ta ri mo len ka su per vi do na fe lor".split()
    word = lambda least=1: "".join(rnd.choices(syllables, k=rnd.randint(least, 3)))
    rows, labels, truth = [], [], {}
    for i in range(900):
        w = [word() for _ in range(30)]
        if toxic := i % 9 == 0:                       # a stem whose inflections hardly repeat
            w[rnd.randrange(30)] = "zwogub" + word(2)
        rows.append((i, " ".join(w), "en", "s", 1))
        truth[i] = int(toxic)
        labels.append((i, 1, int(toxic)))
    got = {r.doc_id: r for r in toxicity.toxicity_scores(
        documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i in truth if got[i].held_out]
    assert sum(truth[i] for i in held) > 10
    assert all(got[i].predicted == truth[i] for i in held)


def test_toxicity_without_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(0, 1, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        assert {r.score for r in toxicity.toxicity_scores(docs, labels).collect()} == {0.0}
        assert rows_of(toxicity.clean_documents(docs, labels)) == rows_of(docs)
    assert toxicity.toxicity_scores(docs.limit(0), none).count() == 0
