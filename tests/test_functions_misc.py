from pyspark.sql import functions as F

from conftest import SF001
from sluice.functions.codes import DEVICES, decode, encode
from sluice.functions.compare import round_cents
from sluice.functions.json import json_key, json_object_text
from sluice.functions.time import (add_seconds, epoch_seconds, floor_minutes, instant_to_ntz,
                                   minute_stamp, ntz_to_instant, seconds_between)
from sluice.operators import audit, ingest, quality
from sluice.sources import scan
from sluice.sources.contract import AggregateRule, contract_from_dict
from sluice.sources.telemetry import load_telemetry


def test_round_cents_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (1.005,), (2.0,)], "x double")
    got = [r[0] for r in df.select(round_cents(F.col("x"))).collect()]
    assert got[0] == 0.12 and got[1] == 0.14 and got[3] == 2.0


def test_time_helpers_are_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kathmandu", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:07.5' AS t")
            r = df.select(epoch_seconds(F.col("t")).alias("e"),
                          seconds_between(F.col("t"), add_seconds(F.col("t"), F.lit(301))).alias("d"),
                          minute_stamp(floor_minutes(F.col("t"), 5)).alias("m"),
                          instant_to_ntz(ntz_to_instant(F.col("t"))).alias("rt"),
                          F.col("t")).first()
            assert r.e == 1710037807 and r.d == 301 and r.m == "20240310T0230" and r.rt == r.t
            x = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-10 04:00:00.25' AS t").select(
                F.unix_micros(ntz_to_instant(F.col("t")))).first()[0]
            assert x == 1704859200250000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_json_and_codes(spark):
    df = spark.createDataFrame([(0, None), (1, "wifi")], "c int, net string")
    out = df.select(decode(F.col("c"), DEVICES).alias("d"),
                    json_object_text([("device", decode(F.col("c"), DEVICES)),
                                      ("network_type", F.col("net"))]).alias("j")).collect()
    assert [r.d for r in out] == ["PS5", "PS4"]
    assert out[0].j == '{"device": "PS5"}' and out[1].j == '{"device": "PS4", "network_type": "wifi"}'
    back = df.select(encode(decode(F.col("c"), DEVICES), DEVICES).alias("c2")).collect()
    assert [r.c2 for r in back] == [0, 1]
    j = spark.createDataFrame([('{"a": 1}',), ("not json",), (None,), ('{"a": null}',), ('{"a": ""}',)], "m string")
    assert [r[0] for r in j.select(json_key(F.col("m"), "a")).collect()] == ["1", None, None, None, ""]


def test_small_files_rule_over_inventory_view(spark, tmp_root):
    t = load_telemetry(spark, SF001)
    t.repartition(20).write.partitionBy("event_date").parquet(f"{tmp_root}/b")
    inv = scan.file_inventory(spark, f"{tmp_root}/b", "event_date")
    rule = AggregateRule("mean_file_kib", "soft",
                         "SELECT AVG(size_bytes) / 1024 AS observed FROM bronze_files",
                         expected=131072.0, tolerance=65536.0)
    rep = quality.evaluate_rules(spark.read.parquet(f"{tmp_root}/b"), [rule],
                                 extra_views={"bronze_files": inv}).first()
    assert rep.flag == "WARN" and rep.observed < 1024      # tiny files: the rule catches them


def test_split_late_side_table(spark):
    t = load_telemetry(spark, SF001)
    main, side = audit.split_late(t, "event_timestamp", "ingestion_timestamp")
    assert main.count() + side.count() == t.count() and side.count() == 1


def test_ingest_all_sources_in_name_order(spark, tmp_root):
    a = spark.range(5).withColumn("p", F.col("id") % 2)
    b = spark.range(3).withColumn("p", F.lit(0))
    a.write.partitionBy("p").parquet(f"{tmp_root}/landing/zeta")
    b.write.partitionBy("p").parquet(f"{tmp_root}/landing/alpha")
    cs = [contract_from_dict({"name": n, "format": "parquet", "landing_path": n, "partition_by": ["p"],
                              "bronze_path": f"{tmp_root}/bronze/{n}", "checkpoint_path": f"{tmp_root}/c/{n}"})
          for n in ("zeta", "alpha")]
    res = ingest.ingest_all(spark, cs, landing_root=f"{tmp_root}/landing")
    assert [(r.source, r.rows) for r in res] == [("alpha", 3), ("zeta", 5)]


def test_binary_blob_catalog_dedups_content(spark, tmp_root):
    import os
    os.makedirs(f"{tmp_root}/blobs", exist_ok=True)
    for i, body in enumerate([b"x" * 10, b"y" * 20, b"x" * 10]):
        with open(f"{tmp_root}/blobs/{i}.png", "wb") as f:
            f.write(body)
    cat = scan.binary_blobs(spark, f"{tmp_root}/blobs", "*.png")
    assert cat.count() == 3 and cat.select("sha256").distinct().count() == 2


def test_sizing_conf_scales_with_input():
    from sluice.session import sizing_conf
    small = sizing_conf(10 << 20)
    big = sizing_conf(100 << 40)          # 100 TiB
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert big["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
    assert int(sizing_conf(10 << 50)["spark.sql.shuffle.partitions"]) == 500_000


def test_conform_casts_adds_typed_nulls_and_keeps_extras(spark):
    from sluice.operators.conformance import conform, conformance_report, typed_nulls
    c = contract_from_dict({"name": "s", "format": "parquet", "landing_path": "s", "bronze_path": "b",
                            "checkpoint_path": "c",
                            "schema": [{"name": "id", "type": "long"}, {"name": "price", "type": "double"},
                                       {"name": "missing_col", "type": "string"}]})
    df = spark.createDataFrame([(1, "2.5", "x"), (2, "oops", "y")], "id int, price string, extra string")
    rep = {r.column_name: r for r in conformance_report(df, c).collect()}
    assert rep["id"].status == "castable" and rep["price"].status == "mismatch"
    assert rep["price"].n_uncastable == 1 and rep["missing_col"].status == "missing"
    assert rep["extra"].status == "extra"
    out = conform(df, c)
    assert dict(out.dtypes) == {"id": "bigint", "price": "double", "extra": "string", "missing_col": "string"}
    assert [r.price for r in out.orderBy("id").collect()] == [2.5, None]
    t = typed_nulls(df, {"n": "bigint", "id": "string"})
    assert dict(t.dtypes)["n"] == "bigint" and dict(t.dtypes)["id"] == "int"


def test_format_report_lines():
    rows = [{"flag": "PASS", "name": "a", "observed": 0.0, "detail": "has to be eq 0"},
            {"flag": "WARN", "name": "b", "observed": None, "detail": "0.1 or less away from 1"}]
    text = quality.format_report(rows).splitlines()
    assert text[0].startswith("PASS  a") and "observed=0.0000" in text[0]
    assert text[1].startswith("WARN  b") and "observed=NULL" in text[1]
