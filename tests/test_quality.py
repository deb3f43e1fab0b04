import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sluice.operators import quality
from sluice.sources.contract import AggregateRule, ContractError, RowRule
from sluice.sources.telemetry import load_telemetry


@pytest.fixture(scope="module")
def t(spark):
    return load_telemetry(spark, SF01)


def report(t, rules):
    return {r["name"]: r for r in quality.enforce(quality.evaluate_rules(t, rules))}


def test_shipped_rules_pass_and_match_fixture_values(t):
    from sluice.sources.contract import contract_from_dict
    from sluice.sources.telemetry import player_events_contract_dict
    c = contract_from_dict(player_events_contract_dict())
    r = report(t, list(c.aggregate_rules))
    assert r["schema_drift_before_boundary"]["observed"] == 0.0
    assert r["hot_game_share"]["observed"] == pytest.approx(0.3783303730017762, abs=1e-15)
    assert r["late_arrival_rate"]["observed"] == pytest.approx(0.025656206828498125, abs=1e-15)
    assert all(x["flag"] == "PASS" for x in r.values())


def test_all_hard_failures_are_reported_together(t):
    rules = [AggregateRule("a", "hard", "SELECT COUNT(*) AS observed FROM bronze", op="eq", value=0),
             AggregateRule("b", "hard", "SELECT 1 AS observed", op="le", value=0),
             AggregateRule("c", "soft", "SELECT 0.5 AS observed", expected=0.0, tolerance=0.1)]
    with pytest.raises(quality.QualityError) as e:
        quality.enforce(quality.evaluate_rules(t, rules))
    assert "[a]" in str(e.value) and "[b]" in str(e.value)


def test_null_and_zero_row_observed(t):
    rules = [AggregateRule("empty_soft", "soft", "SELECT MAX(event_id) AS observed FROM bronze WHERE false",
                           expected=1.0, tolerance=0.1),
             AggregateRule("zero_rows", "soft", "SELECT event_id AS observed FROM bronze WHERE false",
                           expected=1.0, tolerance=0.1)]
    r = report(t, rules)
    assert r["empty_soft"]["observed"] is None and r["empty_soft"]["flag"] == "WARN"
    assert r["zero_rows"]["observed"] is None and r["zero_rows"]["flag"] == "WARN"
    hard = [AggregateRule("h", "hard", "SELECT event_id AS observed FROM bronze WHERE false", op="eq", value=0)]
    rep = quality.evaluate_rules(t, hard).first()
    assert rep.flag == "FAIL" and rep.detail.endswith("(no value)")


def test_unknown_severity_rejected_before_running(t):
    with pytest.raises(ContractError):
        quality.evaluate_rules(t, [AggregateRule("x", "medium", "SELECT 1 AS observed")])


def test_quarantine_counts_add_up(spark, t, tmp_root):
    src = t.withColumn("player_id", F.nullif(F.col("player_id"), F.lit(5)))
    rules = [RowRule("player_id", "not_null"), RowRule("event_id", "not_null")]
    clean, rejects = quality.quarantine(src, rules)
    assert (clean.count(), rejects.count()) == (9599, 535)
    assert rejects.select(F.explode("_reasons")).distinct().collect()[0][0] == "player_id:not_null"
    quality.write_quarantined(src, rules, f"{tmp_root}/q")
    c2, r2 = quality.read_quarantined(spark, f"{tmp_root}/q")
    assert (c2.count(), r2.count()) == (9599, 535)


def test_castability_violation(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    clean, rejects = quality.quarantine(df, [], castable={"v": "bigint"})
    assert clean.count() == 2
    assert [r._reasons for r in rejects.collect()] == [["v:type"]]


def test_checks_are_idempotent_and_empty_table_gives_null(spark, t):
    from sluice.operators import audit
    from sluice.sources.contract import contract_from_dict
    from sluice.sources.telemetry import player_events_contract_dict
    rules = list(contract_from_dict(player_events_contract_dict()).aggregate_rules)
    a = quality.evaluate_rules(t, rules).collect()
    b = quality.evaluate_rules(t, rules).collect()
    assert a == b
    empty = t.limit(0)
    assert audit.late_rate(empty, "event_timestamp", "ingestion_timestamp").first().observed is None
    rep = {r.name: r for r in quality.evaluate_rules(empty, rules).collect()}
    assert rep["hot_game_share"].observed is None and rep["hot_game_share"].flag == "WARN"
