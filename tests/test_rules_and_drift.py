"""Rules in one scan, the lattice of types, the rescue column."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from sluice.functions.compare import compare
from sluice.functions.json import json_object_text
from sluice.operators import conformance, quality
from sluice.sources.contract import ContractError, contract_from_dict
from sluice.sources.telemetry import load_telemetry, player_events_contract_dict


def contract(rules, **more):
    return contract_from_dict({"name": "x", "format": "parquet", "landing_path": "x", "bronze_path": "b", "checkpoint_path": "c",
                               "quality_rules": rules, **more})


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [") + plan.count("Relation[")


def test_metric_rules_share_a_scan(spark):
    t = load_telemetry(spark, SF001)
    rules = list(contract_from_dict(player_events_contract_dict()).aggregate_rules)
    report = quality.evaluate_rules(t, rules)
    assert len(rules) == 6 and scans(report) == 1
    alone = contract([{"name": "n", "severity": "hard", "query": "SELECT COUNT(*) AS observed FROM bronze",
                       "assert": {"op": "ge", "value": 1}}]).aggregate_rules
    both = quality.evaluate_rules(t, [*rules, *alone])
    assert scans(both) == 2
    rows = {r.name: r for r in both.collect()}
    assert rows["n"].observed == t.count() and rows["hot_game_share"].passed
    top = max(r["count"] for r in t.groupBy("game_id").count().collect())
    assert rows["hot_game_share"].observed == pytest.approx(top / t.count())


def test_metrics_on_empty_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (3, 2), (3, None)], "k long, v long")
    rules = contract([
        {"name": "top", "severity": "soft", "per": "k", "metric": "max({n}) / sum({n})", "expected": 0.5, "tolerance": 0},
        {"name": "pairs", "severity": "hard", "per": ["k", "v"], "metric": "count({n})", "assert": {"op": "eq", "value": 3}},
        {"name": "sum", "severity": "hard", "metric": "sum(v)", "assert": {"op": "le", "value": 4}}]).aggregate_rules
    assert {r.name: r.observed for r in quality.evaluate_rules(df, list(rules)).collect()} == {"top": 0.5, "pairs": 3, "sum": 4}
    empty = {r.name: (r.observed, r.passed) for r in quality.evaluate_rules(df.limit(0), list(rules)).collect()}
    assert empty == {"top": (None, False), "pairs": (0, False), "sum": (None, False)}


def test_rules_need_a_query_or_a_metric():
    base = {"name": "r", "severity": "hard", "assert": {"op": "eq", "value": 0}}
    for bad in ({}, {"query": "q", "metric": "m"}, {"per": "k", "query": "q"}, {"per": "k", "metric": "count(*)"}):
        with pytest.raises(ContractError):
            contract([base | bad])


def test_comparisons(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    for op, want in (("eq", [False, True, False]), ("le", [True, True, False]), ("ge", [False, True, True])):
        assert [r[0] for r in df.select(compare(op, F.col("x"), 2.0)).collect()] == want
    with pytest.raises(ValueError):
        compare("lt", F.col("x"), 1)


def test_lattice():
    assert conformance.widest(["int", "bigint"]) == "bigint"
    assert conformance.widest(["tinyint", "double"]) == "double"
    assert conformance.widest(["bigint", "double"]) == "string"       # neither holds the other's values
    assert conformance.widest(["date", "timestamp_ntz"]) == "timestamp_ntz"
    assert conformance.widest(["void", "int"]) == "int"
    assert conformance.widest(["array<int>", "array<int>"]) == "array<int>"
    assert conformance.widest(["array<int>", "int"]) == "string"


def test_drifted_files_and_rescued_values(spark, tmp_root):
    spark.createDataFrame([(1, 5)], "id int, a int").write.parquet(f"{tmp_root}/1")
    spark.createDataFrame([(2, "x"), (3, "7"), (4, None)], "id bigint, a string").write.parquet(f"{tmp_root}/2")
    spark.createDataFrame([(5, "2024-13-45")], "id bigint, d string").write.parquet(f"{tmp_root}/3")
    df = conformance.read_drifted(spark, [[f"{tmp_root}/{i}"] for i in (1, 2, 3)])
    assert dict(df.dtypes) == {"id": "bigint", "a": "string", "d": "string"}
    c = contract([], schema=[{"name": "id", "type": "long"}, {"name": "a", "type": "long"}, {"name": "d", "type": "timestamp"},
                             {"name": "absent", "type": "double"}])
    out = {r.id: r for r in conformance.conform_rescued(df, c).collect()}
    assert {i: r.a for i, r in out.items()} == {1: 5, 2: None, 3: 7, 4: None, 5: None}
    assert {i: json.loads(r._rescued) for i, r in out.items() if r._rescued} == {2: {"a": "x"}, 5: {"d": "2024-13-45"}}
    assert all(r.absent is None for r in out.values())
    assert conformance.conform_rescued(df.limit(0), c).count() == 0
    kinds = conformance.type_drift({"1": T._parse_datatype_string("a int, b int"), "2": T._parse_datatype_string("a bigint")})
    assert kinds == [("a", "int,bigint", "bigint", "widened"), ("b", "int", "int", "partial")]


def test_json_text_of_any_value(spark):
    odd = ['a"b', "back\\slash", "line\nbreak\ttab\r", "\x01\x1f", "ünï 😀", "", None, "</x>"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    for (v,), (text,) in zip([(v,) for v in odd], df.select(json_object_text([("k\"", F.col("v")), ("z", F.lit("1"))])).collect()):
        assert json.loads(text) == ({"k\"": v, "z": "1"} if v is not None else {"z": "1"})
    plain = df.where("v = 'back\\\\\\\\slash'").select(json_object_text([("d", F.lit("PS5")), ("n", F.lit("wifi"))])).first()
    assert plain is None or plain[0] == '{"d": "PS5", "n": "wifi"}'
