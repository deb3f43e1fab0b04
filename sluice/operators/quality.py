"""Data-quality rules: aggregate SQL rules with hard/soft severity, a report
DataFrame, and row rules that quarantine failing rows with their reasons.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.compare import compare, within_tolerance
from sluice.sources.contract import AggregateRule, ContractError, RowRule

REPORT_COLUMNS = ["name", "severity", "observed", "passed", "flag", "detail"]


class QualityError(Exception):
    """One or more hard rules failed."""


def _verdict(rule: AggregateRule, observed: Column) -> list[Column]:
    """The report's columns for a rule and its value. No value (no rows to take
    it from) is a failure, reported as such."""
    observed = observed.cast("double")
    if rule.severity == "hard":
        passed = F.coalesce(compare(rule.op, observed, float(rule.value)), F.lit(False))
        detail = F.when(observed.isNull(), F.lit(rule.detail + " (no value)")).otherwise(F.lit(rule.detail))
    else:
        passed = F.coalesce(within_tolerance(observed, rule.expected, rule.tolerance), F.lit(False))
        detail = F.lit(rule.detail)
    flag = F.when(passed, "PASS").otherwise("FAIL" if rule.severity == "hard" else "WARN")
    return [F.lit(rule.name).alias("name"), F.lit(rule.severity).alias("severity"), observed.alias("observed"),
            passed.alias("passed"), flag.alias("flag"), detail.alias("detail")]


def _rule_row(spark: SparkSession, rule: AggregateRule) -> DataFrame:
    """A rule with a query of its own."""
    if "observed" not in spark.sql(rule.query).columns:
        raise ContractError(f"[{rule.name}] rule query must return a column named observed")
    # Wrapped as a scalar subquery: exactly one report row per rule. A query
    # with no rows gives NULL (reported, not a crash); more than one row is
    # an error raised by Spark.
    q = rule.query.strip().rstrip(";")
    return spark.sql(f"SELECT (SELECT observed FROM ({q}) AS _rule) AS observed").select(
        *_verdict(rule, F.col("observed")))


def _metric_rows(table: DataFrame, rules: list[AggregateRule]) -> DataFrame:
    """All rules with a metric, from one scan. Grouping sets count the rows per
    group of every rule's ``per`` columns, and the empty set has the metrics over
    rows; a second, small aggregate takes the metrics over groups."""
    sets = [(), *dict.fromkeys(r.per for r in rules if r.per)]
    cols = list(dict.fromkeys(c for s in sets for c in s))
    over_rows = {f"_m{i}": F.expr(r.metric) for i, r in enumerate(rules) if not r.per}
    aggs = [F.count(F.lit(1)).alias("_n"), *[m.alias(n) for n, m in over_rows.items()]]
    if cols:
        kept = table.withColumns({f"_by{i}": F.col(c) for i, c in enumerate(cols)})
        by = [f"_by{i}" for i in range(len(cols))]
        grouped = kept.groupingSets([[f"_by{cols.index(c)}" for c in s] for s in sets], *by).agg(
            F.grouping_id().alias("_gid"), *aggs)
        gid = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets}
        # The counts of each set under a name of their own, NULL on other sets' rows.
        grouped = grouped.withColumns({f"_n{k}": F.when(F.col("_gid") == gid[s], F.col("_n")) for k, s in enumerate(sets)})
        whole = F.col("_gid") == gid[()]
    else:
        grouped, whole = table.agg(*aggs), F.lit(True)
    values = [F.expr(r.metric.replace("{n}", f"_n{sets.index(r.per)}")) if r.per
              else F.max(F.when(whole, F.col(f"_m{i}"))) for i, r in enumerate(rules)]
    one = grouped.agg(*[v.cast("double").alias(f"_v{i}") for i, v in enumerate(values)])
    return one.select(F.inline(F.array(*[F.struct(*_verdict(r, F.col(f"_v{i}"))) for i, r in enumerate(rules)])))


def evaluate_rules(table: DataFrame, rules: list[AggregateRule], view: str = "bronze",
                   extra_views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every rule as one row of a single report DataFrame (one Spark job for
    all rules). Rules with a metric share one scan, those with a query have
    their own. Read-only over the table, so two runs give the same report.
    ``extra_views`` registers more views for rules that need them, e.g. the
    table's file inventory (``bronze_files``) for a small-files rule."""
    if not rules:
        raise ContractError("no aggregate rules to evaluate")
    for r in rules:
        if r.severity not in ("hard", "soft"):
            raise ContractError(f"[{r.name}] unknown severity {r.severity!r}")
    spark = table.sparkSession
    table.createOrReplaceTempView(view)
    for name, df in (extra_views or {}).items():
        df.createOrReplaceTempView(name)
    metrics = [r for r in rules if r.metric]
    rows = [_metric_rows(table, metrics)] if metrics else []
    rows += [_rule_row(spark, r) for r in rules if not r.metric]
    return reduce(DataFrame.unionAll, rows)


def enforce(report: DataFrame) -> list[dict]:
    """Collect the report (one row per rule, bounded by the rule count) and
    raise listing every failed hard rule; soft failures are returned as WARN."""
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["severity"] == "hard" and not r["passed"]]
    if failed:
        msg = "; ".join(f"[{r['name']}] observed={r['observed']} ({r['detail']})" for r in failed)
        raise QualityError(f"hard rule(s) failed: {msg}")
    return rows


def format_report(rows: list[dict]) -> str:
    """The report as text: a line per rule with its verdict, its name in a
    column as wide as the longest, the value found and what was asked."""
    width = max((len(r["name"]) for r in rows), default=0)
    lines = []
    for r in rows:
        value = format(r["observed"], ".4f") if r["observed"] is not None else "NULL"
        lines.append(" ".join([r["flag"].ljust(5), r["name"].ljust(width), "observed=" + value, "/ " + r["detail"]]))
    return "\n".join(lines)


def _row_rule_violation(rule: RowRule) -> Column:
    if rule.rule == "not_null":
        return F.col(rule.column).isNull()
    raise ContractError(f"unknown row rule {rule.rule!r}")


def flag_violations(df: DataFrame, rules: list[RowRule],
                    castable: dict[str, str] | None = None) -> DataFrame:
    """Add ``_reasons``: array of the names of the rules each row breaks.
    ``castable`` maps column -> declared type; a non-NULL value that does not
    cast is a violation named ``<col>:type``."""
    checks = [F.when(_row_rule_violation(r), F.lit(r.name)) for r in rules]
    for c, t in (castable or {}).items():
        checks.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                             F.lit(f"{c}:type")))
    if not checks:
        return df.withColumn("_reasons", F.array().cast("array<string>"))
    return df.withColumn("_reasons", F.array_compact(F.array(*checks)))


def quarantine(df: DataFrame, rules: list[RowRule],
               castable: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects): every input row lands in exactly one of them; rejects
    keep all columns plus ``_reasons``. Both sides derive from one flagged
    plan; use :func:`write_quarantined` to produce both in a single pass."""
    flagged = flag_violations(df, rules, castable)
    bad = F.size("_reasons") > 0
    return flagged.where(~bad).drop("_reasons"), flagged.where(bad)


def write_quarantined(df: DataFrame, rules: list[RowRule], path: str,
                      castable: dict[str, str] | None = None,
                      partition_by: list[str] | None = None) -> None:
    """One scan, one write: rows land under ``_status=clean`` or
    ``_status=rejected`` (rejected rows carry ``_reasons``)."""
    flagged = flag_violations(df, rules, castable)
    from sluice.operators.ingest import write_table

    out = flagged.withColumn(
        "_status", F.when(F.size("_reasons") > 0, "rejected").otherwise("clean"))
    write_table(out, path, ["_status", *(partition_by or [])], "overwrite")


def read_quarantined(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    t = spark.read.parquet(path)
    clean = t.where(F.col("_status") == "clean").drop("_status", "_reasons")
    rejects = t.where(F.col("_status") == "rejected").drop("_status")
    return clean, rejects
