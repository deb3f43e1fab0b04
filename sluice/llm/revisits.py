"""WARC not-modified revisits resolved to the response they stand for.

A revisit record (a 304 answer) takes the latest earlier full response of its
canonical URL. Its validators decide whether it may: entity tags by weak
comparison, else the modification time. The resolved record has the
response's payload and headers, with those headers of the 304 that it may
update (``PERMITTED``).

The as-of join is a sort: records are dealt by range of (URL, time, id), so a
URL with a third of all records lies over many partitions. In each partition a
window carries the last response on; a summary of one row per partition and
URL carries it across partitions. Only headers and digests move, no payload.

Nulls: revisits without a URL, a time or an earlier response have the status
``no_response``; without a validator on either side, ``no_validator``; with
others, ``mismatch``. A response without a URL or a time is no one's earlier one.
Records that are neither response nor revisit (requests, metadata, a null kind)
come out as they are, with the status ``not_a_revisit``. Records of the same URL
and time go by id; repeated records are each resolved. Null headers count as none.
Header names are compared in lower case. Empty tables give no rows; columns
other than ``COLUMNS`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialise

COLUMNS = ("record_id", "kind", "url", "time", "digest", "headers")

#: The header fields a 304 answer sends to update a stored one (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

#: Query parameters that don't change the page.
IGNORED = "^(ref|sessionid|utm_[a-z]+)="


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www./m., default port, fragment, trailing
    slash and ignored parameters; the other parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"^[A-Za-z]+://(www\.|m\.)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(IGNORED)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_keys(headers: Column) -> Column:
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    # of names that differ only in case, the last one counts
    names = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.map_from_entries(F.transform(
        names, lambda n: F.element_at(F.filter(pairs, lambda e: e["key"] == n), -1)))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per record that isn't a response: record_id, url_key, status,
    response_id, digest and headers of the resolved record (its own if
    unresolved)."""
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("key"), "time",
        F.coalesce(F.col("kind") == "response", F.lit(False)).alias("full"),
        F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("revisit"),
        F.col("digest"), _lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"))
    order = [F.col("key").asc_nulls_first(), F.col("time").asc_nulls_first(), F.col("record_id").asc_nulls_first()]
    dealt = materialise(
        rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "captures")
    response = F.when(F.col("full") & F.col("time").isNotNull(), F.struct("record_id", "digest", "headers"))
    last = materialise(
        dealt.where("full and key is not null and time is not null").groupBy("part", "key").agg(
            F.max_by(F.struct("record_id", "digest", "headers"),
                     F.struct("time", "record_id")).alias("last")), "last-responses")
    parts = dealt.where("key is not null").select("part", "key").distinct()
    across = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.join(last, ["part", "key"], "left").select(
        F.col("part").alias("p"), F.col("key").alias("k"), F.last("last", ignorenulls=True).over(across).alias("carried"))
    carried = materialise(carried.where("carried is not null"), "carried-responses")
    inside = Window.partitionBy("part", "key").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    seen = dealt.withColumn("before", F.last(response, ignorenulls=True).over(inside)).where("not full")
    both = seen.join(carried, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k")), "left")
    r = F.coalesce("before", "carried")
    both = both.withColumn("r", F.when(F.col("key").isNotNull() & F.col("time").isNotNull() & F.col("revisit"), r))
    mine, theirs = F.col("headers"), F.col("r.headers")
    tags = mine["etag"].isNotNull() & theirs["etag"].isNotNull()
    times = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    same = F.when(tags, _tag(mine) == _tag(theirs)).when(times, mine["last-modified"] == theirs["last-modified"])
    status = (F.when(~F.col("revisit"), "not_a_revisit").when(F.col("r").isNull(), "no_response").when(same.isNull(), "no_validator")
              .when(same, "resolved").otherwise("mismatch"))
    update = F.map_filter(mine, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(update, k)), update)
    return both.withColumn("status", status).select(
        "record_id", F.col("key").alias("url_key"), "status", F.col("r.record_id").alias("response_id"),
        F.when(F.col("status") == "resolved", F.col("r.digest")).alias("digest"),
        F.when(F.col("status") == "resolved", merged).otherwise(mine).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records of the pages: of each a full response, and a later
    revisit with its entity tag (weak), or its modification time, or a tag of
    another state, or no validator."""
    n = F.col("page_id")
    etag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    modified = F.concat(F.lit("t"), (n % 100).cast("string"))
    first, later = n * 100, n * 100 + 50 + n % 13 * 700
    no_text = F.lit(None).cast("string")

    def headers(**pairs: Column) -> Column:
        m = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k.replace("_", "-")), v)])
        return F.map_filter(m, lambda k, v: v.isNotNull())

    kind = n % 10
    response = F.struct(
        (2 * n).alias("record_id"), F.lit("response").alias("kind"), F.col("url"), first.alias("time"),
        F.md5(F.col("html").cast("binary")).alias("digest"),
        headers(Content_Type=F.lit("text/html"), Content_Length=F.octet_length("html").cast("string"), ETag=etag,
                Last_Modified=modified, Date=first.cast("string"),
                Cache_Control=F.concat(F.lit("max-age="), (n % 7).cast("string"))).alias("headers"))
    revisit = F.struct(
        (2 * n + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.col("url"), later.alias("time"),
        no_text.alias("digest"),
        headers(Content_Length=F.lit("0"), Connection=F.lit("close"), Date=later.cast("string"),
                ETag=F.when(kind < 7, F.concat(F.lit("W/"), etag)).when(kind == 8, F.lit('"other"')),
                Last_Modified=F.when(kind == 7, modified),
                Expires=F.when(kind < 3, (later + 1000).cast("string"))).alias("headers"))
    return pages.select(F.explode(F.array(response, revisit)).alias("c")).select("c.*")
