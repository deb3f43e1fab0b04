"""Sharding, mixing, packing, token counts and revisits on small tables."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.fixtures import DOC, doc_rows, documents
from sluice.llm import mixing, packing, revisits, sharding, token_counts, tokens


def brute_minimax(sizes, shards):
    """Smallest largest shard by dynamic programming."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    n = len(sizes)
    best = list(ends)
    for _ in range(shards - 1):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(n + 1)]
    return best[n]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_minimax(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 3)      # many ranges have to be split
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    rnd = random.Random(seed)
    n = rnd.choice([1, 5, 60])
    keys = rnd.sample(range(1 << 20), n) if seed % 2 else [rnd.randrange(1 << 60) for _ in range(n)]
    sizes = [rnd.choice([1, 3, 50, 400]) for _ in range(n)]
    groups = spark.createDataFrame(sorted(zip(keys, sizes)), "key long, size long")
    capacity, cuts = sharding.minimax_cuts(groups, 5)
    ordered = sorted(zip(keys, sizes))
    assert capacity == brute_minimax([s for _, s in ordered], 5)
    load = defaultdict(int)
    for k, s in ordered:
        load[sum(k >= c for c in cuts)] += s
    assert max(load.values()) <= capacity


def test_shards_of_documents(spark):
    docs = documents(spark)
    got = sharding.shard_documents(docs, shards=4).collect()
    assert len(got) == len(doc_rows())
    by_text = defaultdict(set)
    texts = {i: t for i, t, *_ in doc_rows()}
    for r in got:
        text = texts[r.doc_id]
        assert r["size"] == len((text or "").encode()) + 8
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
        by_text[text].add(r.shard)
        assert 0 <= r.shard < 4
    assert all(len(v) == 1 for v in by_text.values())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def water(sizes, weights, share, most):
    total, full = share * sum(sizes), set()
    while True:
        free = sum(w for i, w in enumerate(weights) if i not in full)
        level = (total - sum(most * sizes[i] for i in full)) / free if free else 0
        over = {i for i, w in enumerate(weights) if i not in full and w * level > most * sizes[i]}
        if not over:
            return [most * s if i in full else w * level for i, (s, w) in enumerate(zip(sizes, weights))]
        full |= over


def test_mix_targets_and_copies(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", f"s{i % 5}" if i % 11 else None, 1) for i in range(400)]
    docs = documents(spark, rows)
    plan = mixing.plan_mix(docs).collect()
    names = sorted({r.source for r in plan if r.source}) + [None]
    sizes = [sum(r["size"] for r in plan if r.source == n) for n in names]
    goal = dict(zip(names, water(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)))
    for n, s in zip(names, sizes):
        mine = [r for r in plan if r.source == n]
        assert all(abs(r.target - goal[n]) < 1e-6 and r.source_size == s and r.copies <= 2 for r in mine)
        assert abs(sum(r["size"] * r.copies for r in mine) - goal[n]) <= 0.05 * goal[n] + 7
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, mixing.plan_mix(docs).collect()), key=repr)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in plan)


def test_mix_odd_rows(spark):
    plan = mixing.plan_mix(documents(spark)).collect()
    assert len(plan) == len(doc_rows())
    size = {r.doc_id: r["size"] for r in plan}
    assert size[4] == size[5] == size[6] == 0 and size[7] == 2
    for df in (spark.createDataFrame([], DOC), spark.createDataFrame([(1, None, "en", "a", 1)], DOC)):
        assert all(r.copies == 0 for r in mixing.plan_mix(df).collect())
        assert mixing.mix(df).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [b for b in range(len(rooms)) if rooms[b] >= x]
        if fits:
            rooms[min(fits, key=lambda b: rooms[b])] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 50, 200])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 300))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    plan = packing.best_fit_plan(histogram, capacity)
    bins = defaultdict(list)
    for length, n in histogram.items():
        runs = sorted(r for r in plan if r[0] == length)
        for nth in range(n):
            _, first, at, per, offset = [r for r in runs if r[1] <= nth][-1]
            bins[at + (nth - first) // per].append((offset + (nth - first) % per * length, length))
    rooms = []
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        rooms.append(capacity - end)
    assert sorted(rooms) == plain_best_fit(lengths, capacity)


def test_pieces_of_documents(spark):
    got = packing.pack_documents(documents(spark), capacity=64).collect()
    tok = tokens.load(tokens.default_path(packing.WORD_BPE))
    texts = {i: t or "" for i, t, *_ in doc_rows()}
    copies = defaultdict(list)
    for r in got:
        copies[r.doc_id].append(r)
    for i, rows in copies.items():
        ids = tok.encode(texts[i], add_special_tokens=False).ids + [0]
        times = sum(1 for j, *_ in doc_rows() if j == i)
        want = [(p, s, len(ids[s:s + 64]), zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes()))
                for p, s in enumerate(range(0, len(ids), 64))] * times
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    full = defaultdict(list)
    for r in got:
        full[r.sequence_id].append((r.offset, r.length))
    for placed in full.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack_documents(documents(spark).limit(0)).count() == 0


ODD = ["", " ", "\n\n", "it's 12a\t\t b\x1c c ", "é\xa0 ü\n\n  x", "ab <|endoftext|> cd<|endoftext|>", "<|EndOfText|> A",
       "don't they'll  'tis", "Σίσυφος ΣΑΣ ᾳ ﬁ ½ ²", "é ́x", "漢字 かな 😀😀", "a.b,c; (d)... !!", "  a　 b"]


def test_few_texts_are_python_objects_at_once():
    import pyarrow as pa
    from sluice.llm import tokens
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(["a few words"] * 1200)], names=["doc_id", "text"])
    out = list(packing.cut_pieces([batch], tokens.default_path(packing.WORD_BPE), 64))
    assert [b.num_rows for b in out] == [500, 500, 200]
    assert [x for b in out for x in b.column("doc_id").to_pylist()] == [*range(1200)]


def test_gapless_shuffles_rows_once_while_offsets_are_few(spark):
    from sluice.llm import common
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("g")).unionByName(
        spark.range(50).select("id", F.lit(None).cast("long").alias("g"))).localCheckpoint()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = common.gapless(df, ["g"], ["id"], "n", 430, per_task=50)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for g in [*range(7), None]:
        n = sorted(r.n for r in rows if r.g == g)
        assert n == [*range(len(n))] and len(n) >= 50


@pytest.mark.parametrize("text", ODD + [t for _, t, *_ in doc_rows() if t])
def test_memoised_encoding_is_the_library_s(text):
    byte, word = tokens.default_path("byte_bpe_50k.json"), tokens.default_path("word_bpe_49k.json")
    ids = tokens.load(byte).encode(text, add_special_tokens=False).ids
    assert next(tokens.memo(tokens.UnitCounts, byte).counts([text])) == len(ids)
    assert tokens.spliced_ids(text, byte, chunk=50, overlap=4)[0] == ids
    got = np.frombuffer(next(tokens.memo(tokens.WordIds, word).encode([text.encode()])), "<u4").tolist()
    assert got == tokens.load(word).encode(text, add_special_tokens=False).ids


def test_overlaps_widen_until_they_align():
    path = tokens.default_path("byte_bpe_50k.json")
    for text in ("a" * 900 + " b " + "c" * 700, " " * 800 + "x" + " " * 500, "ab " * 700):
        ids, widened = tokens.spliced_ids(text, path, chunk=100, overlap=8)
        assert ids == tokens.load(path).encode(text, add_special_tokens=False).ids
        assert (widened > 0) == (text[:3] != "ab ")


def test_counts_of_documents(spark):
    got = {r.doc_id: r for r in token_counts.token_counts(documents(spark)).collect()}
    tok = tokens.load(tokens.default_path(token_counts.BYTE_BPE))
    for i, text, *_ in doc_rows():
        n = len(tok.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 512)
    assert token_counts.token_counts(documents(spark).limit(0)).count() == 0


def test_revisits(spark):
    schema = "record_id long, kind string, url string, time long, digest string, headers map<string,string>"
    rows = [
        (1, "response", "http://www.A.example:80/x/?b=2&ref=q&a=1#f", 10, "d1", {"ETag": '"e"', "Content-Type": "t", "Vary": "v"}),
        (2, "revisit", "https://a.example/x?a=1&b=2", 20, None, {"etag": 'W/"e"', "Date": "20", "Content-Type": "no"}),
        (3, "response", "http://a.example/x?a=1&b=2", 30, "d3", {"ETag": '"g"', "Last-Modified": "m"}),
        (4, "revisit", "http://a.example/x?a=1&b=2", 40, None, {"etag": '"e"'}),
        (5, "revisit", "http://a.example/x?a=1&b=2", 30, None, {"last-modified": "m"}),
        (6, "revisit", "http://a.example/x?a=1&b=2", 5, None, {"etag": '"e"'}),
        (7, "revisit", "http://a.example/x?a=1&b=2", 50, None, None), (8, "revisit", None, 50, None, {"etag": '"e"'}),
        (9, "response", None, 1, "d9", {"etag": '"e"'}), (10, "revisit", "http://b.example/", None, None, {}),
        (2, "revisit", "https://a.example/x?a=1&b=2", 20, None, {"etag": 'W/"e"', "Date": "20", "Content-Type": "no"}),
        (11, None, "http://a.example/x?a=1&b=2", 60, None, {"etag": '"g"'}),
        (12, "request", "http://a.example/x?a=1&b=2", 60, None, {"Host": "a"}),
        (13, "response", "http://c.example/", None, "d13", {"etag": '"c"'}),
        (14, "revisit", "http://c.example/", 9, None, {"etag": '"c"'}), (None, "revisit", "http://a.example/x?a=1&b=2", 60, None, None)]
    got = revisits.resolve_revisits(spark.createDataFrame(rows, schema).withColumn("key", F.lit("clash")))
    by = {r.record_id: r for r in got.collect()}
    assert got.count() == 12
    assert by[11].status == by[12].status == "not_a_revisit" and by[11].response_id is None
    assert by[12].headers == {"host": "a"} and by[14].status == "no_response" and by[None].status == "no_validator"
    assert by[2].status == "resolved" and by[2].response_id == 1 and by[2].digest == "d1"
    assert by[2].headers == {"etag": 'W/"e"', "date": "20", "content-type": "t", "vary": "v"}
    assert by[4].status == "mismatch" and by[4].response_id == 3 and by[4].headers == {"etag": '"e"'}
    assert by[5].status == "resolved" and by[5].response_id == 3
    assert by[6].status == "no_response" and by[7].status == "no_validator"
    assert by[8].status == "no_response" and by[10].status == "no_response"
    assert revisits.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_pages_without_an_id_stay(spark):
    from conftest import duck
    from sluice.llm.queries import ORACLE

    pages = spark.createDataFrame([(1, "http://a.example/x", "h"), (None, "http://a.example/x", "h"), (None, None, None),
                                   (4, "http://a.example/x", None)], "page_id long, url string, html string")
    got = revisits.resolve_revisits(revisits.captures_of_pages(pages)).collect()
    con = duck("/root/testdata/sf0.001")
    con.register("frame", pages.toPandas().astype({"page_id": "Int64"}))
    want = con.sql("WITH pages AS (SELECT page_id::BIGINT AS page_id, url, html FROM frame), "
                   + ORACLE["op1_warc_revisits"].strip()[len("WITH "):]).fetchall()
    assert sorted([(r.record_id, r.url_key, r.status, r.response_id, r.digest) for r in got], key=repr) == \
        sorted([w[:5] for w in want], key=repr) and len(got) == 4


def test_a_hot_url_lies_over_many_partitions(spark):
    n = 4000
    rows = spark.range(n).select(
        F.col("id").alias("record_id"), F.when(F.col("id") % 10 == 0, "response").otherwise("revisit").alias("kind"),
        F.lit("http://one.example/").alias("url"), F.col("id").alias("time"), F.col("id").cast("string").alias("digest"),
        F.create_map(F.lit("etag"), F.lit("e")).alias("headers"))
    got = revisits.resolve_revisits(rows)
    assert got.where("status = 'resolved' and response_id = record_id - record_id % 10").count() == n - n // 10
