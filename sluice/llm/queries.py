"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.llm.common import WORD, table


def op1_warc_revisits(spark, sf_dir):
    from sluice.llm.revisits import captures_of_pages, resolve_revisits

    out = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return out.withColumn("headers", F.array_join(lines, "; "))


def op2_source_mix(spark, sf_dir):
    from sluice.llm.mixing import plan_mix

    return plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_best_fit_packing(spark, sf_dir):
    from sluice.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op4_minhash_forest(spark, sf_dir):
    from sluice.llm.minhash_forest import near_duplicate_texts

    return near_duplicate_texts(table(spark, sf_dir, "documents"), shingle=4)


def op5_trie_lm(spark, sf_dir):
    from sluice.llm.trie_lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op6_string_kernel_toxicity(spark, sf_dir):
    from sluice.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pivot_topk(spark, sf_dir):
    from sluice.llm.topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark, sf_dir):
    from sluice.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op9_minimax_shards(spark, sf_dir):
    from sluice.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_int8_vector_dedup(spark, sf_dir):
    from sluice.llm.embedding_dedup import near_duplicate_vectors

    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_embedding_whitening(spark, sf_dir):
    from sluice.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_best_fit_windows(spark, sf_dir):
    from sluice.llm.windows import pack_windows

    return pack_windows(table(spark, sf_dir, "documents"))


def with_planted_repeats(docs):
    """doc_id and text: as the contract of op13 wants it, in every tenth document
    (by the id's crc32) the words from a place on repeat with a period."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), 1)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    start = F.expr("cast(g % size(w) as int)")
    period = F.expr("cast(1 + (size(w) - cast(g % size(w) as int)) div (3 + g % 8) as int)")
    spread = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", F.col("a") + F.pmod(i - F.col("a"), F.col("p")))))
    planted = rows.withColumns({"a": F.when(n > 0, start), "p": F.when(n > 0, period)})
    return planted.select("doc_id", F.when(n > 0, F.array_join(spread, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    from sluice.llm.runs import periodic_runs

    found = periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    # Runs are in order of start and period, so the first of equal exponents stays.
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]),
                                                  F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_source_mix": op2_source_mix,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_minhash_forest": op4_minhash_forest,
    "op5_trie_lm": op5_trie_lm,
    "op6_string_kernel_toxicity": op6_string_kernel_toxicity,
    "op7_pivot_topk": op7_pivot_topk,
    "op8_token_counts": op8_token_counts,
    "op9_minimax_shards": op9_minimax_shards,
    "op10_int8_vector_dedup": op10_int8_vector_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_best_fit_windows": op12_best_fit_windows,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op1_warc_revisits": r"""
WITH bare AS (
  SELECT page_id AS n, html,
         regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z]+://(www\.|m\.)?', '') AS b FROM pages),
parts AS (
  SELECT n, html, regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '^(ref|sessionid|utm_[a-z]+)='))) AS asked
  FROM bare),
p AS (
  SELECT n, n % 10 AS kind, '"' || md5(html) || '"' AS etag, md5(html) AS digest, octet_length(encode(html)) AS bytes,
         't' || (n % 100) AS modified, n * 100 AS first, n * 100 + 50 + n % 13 * 700 AS later,
         host || path || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS url_key
  FROM parts),
v AS (
  SELECT 2 * n + 1 AS record_id, url_key, later, CASE WHEN kind < 7 THEN etag WHEN kind = 8 THEN '"other"' END AS tag,
         CASE WHEN kind < 7 THEN 'W/' || etag WHEN kind = 8 THEN '"other"' END AS sent,
         CASE WHEN kind = 7 THEN modified END AS modified, CASE WHEN kind < 3 THEN later + 1000 END AS expires FROM p),
best AS (
  SELECT v.record_id, max(2 * p.n) AS response_id FROM v JOIN p
  ON p.url_key = v.url_key AND (p.first < v.later OR p.first = v.later AND 2 * p.n < v.record_id) GROUP BY 1),
j AS (
  SELECT v.*, r.digest, r.etag, r.modified AS r_modified, r.bytes, r.n, b.response_id,
         CASE WHEN b.response_id IS NULL THEN 'no_response'
              WHEN v.tag IS NOT NULL AND r.etag IS NOT NULL THEN CASE WHEN v.tag = r.etag THEN 'resolved' ELSE 'mismatch' END
              WHEN v.modified IS NOT NULL THEN CASE WHEN v.modified = r.modified THEN 'resolved' ELSE 'mismatch' END
              ELSE 'no_validator' END AS status
  FROM v LEFT JOIN best b USING (record_id) LEFT JOIN p r ON 2 * r.n = b.response_id)
SELECT record_id, url_key, status, response_id, CASE WHEN status = 'resolved' THEN digest END AS digest,
  CASE WHEN status = 'resolved' THEN array_to_string(list_filter([
      'cache-control: max-age=' || (n % 7), 'content-length: ' || bytes, 'content-type: text/html', 'date: ' || later,
      'etag: ' || coalesce(sent, etag), 'expires: ' || expires, 'last-modified: ' || coalesce(modified, r_modified)],
      lambda x: x IS NOT NULL), '; ')
  ELSE array_to_string(list_filter([
      'connection: close', 'content-length: 0', 'date: ' || later, 'etag: ' || sent, 'expires: ' || expires,
      'last-modified: ' || modified], lambda x: x IS NOT NULL), '; ') END AS headers
FROM j
""",
    "op2_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM src),
capped AS (
  SELECT *, (2 * source_size)::DOUBLE AS cap, row_number() OVER w AS nth,
         coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         (SELECT sum(source_size) FROM src) * 1.5::DOUBLE AS total
  FROM weighted WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
levels AS (SELECT arg_min((total - before) / free, nth) FILTER (WHERE cap >= weight * ((total - before) / free)) AS level
           FROM capped),
goal AS (
  SELECT source, source_size, least(cap, weight * level) AS target,
         CASE WHEN source_size > 0 THEN least(cap, weight * level) / source_size ELSE 0 END AS rate
  FROM capped, levels),
joined AS (
  SELECT d.doc_id, d.size, g.*, floor(rate) AS whole,
         list_transform(range(16), lambda i: ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':' || (i // 4)),
                        (1 + 8 * (i % 4))::INT, 8))::BIGINT / 4294967296.0::DOUBLE) AS u
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
drawn AS (
  SELECT source, target, i, sum(size * (whole + (u[i + 1] < rate - whole)::INT)) AS taken
  FROM joined, range(16) r(i) GROUP BY ALL),
best AS (SELECT source, arg_min(i, (abs(taken - target), i)) AS draw FROM drawn GROUP BY source)
SELECT j.doc_id, j.size, j.source_size, j.target,
       (j.size * (whole + (u[draw + 1] < rate - whole)::INT))::BIGINT AS taken
FROM joined j JOIN best b ON j.source IS NOT DISTINCT FROM b.source
""",
    "op7_pivot_topk": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""",
    "op10_int8_vector_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_inner_product(list_transform(embedding, lambda x: x::DOUBLE),
                           list_transform(embedding, lambda x: x::DOUBLE)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(b) FROM reach r WHERE r.a = e.vec_id) AS kept
FROM embeddings e
""",
    "op4_minhash_forest": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
t AS (SELECT doc_id, len(sh)::BIGINT AS n, unnest(sh) AS x FROM s),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM t p JOIN t q ON p.x = q.x AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN c ON s.doc_id = c.a
""",
}
