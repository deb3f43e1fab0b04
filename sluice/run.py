"""Command line: ingest every source contract of a folder (name order), run
each source's aggregate quality rules over its Bronze table, and refine it:
row rules send rows to the rejects, clean rows become Silver and Gold.

    python -m sluice.run --contracts contracts/ --landing-root /data/landing [--incremental] [--optimize]

``--optimize`` first packs the Bronze table's small files: file by file if it is
incremental, else partition by partition; a contract with ``zorder_by`` also gets
a clustered snapshot beside it. Rules see the table's files as ``bronze_files``.

All contracts are validated before the first source is written. A failed
hard rule stops the run with every failed rule listed.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators import maintain
from sluice.operators.bronze_compaction import compact_bronze, live_files
from sluice.operators.ingest import ingest_full_refresh
from sluice.operators.quality import enforce, evaluate_rules, format_report
from sluice.operators.refine import refine
from sluice.session import ensure_checkpoint_dir
from sluice.sources.contract import load_contracts
from sluice.sources.scan import file_inventory
from sluice.streaming.incremental import ingest_incremental, read_bronze


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="sluice.run")
    ap.add_argument("--contracts", required=True, help="folder of *.yaml source contracts")
    ap.add_argument("--landing-root", default=None, help="prefix for each contract's landing_path")
    ap.add_argument("--root", default=None,
                    help="prefix for relative bronze_path / checkpoint_path of the contracts")
    ap.add_argument("--incremental", action="store_true", help="ingest only unseen files")
    ap.add_argument("--optimize", action="store_true", help="pack small files, cluster by the contract's zorder_by")
    args = ap.parse_args(argv)
    contracts = load_contracts(args.contracts)          # all validated up front
    if args.root:
        def anchor(p: str) -> str:
            return p if "://" in p or p.startswith("/") else f"{args.root.rstrip('/')}/{p}"
        contracts = [dataclasses.replace(c, bronze_path=anchor(c.bronze_path),
                                         checkpoint_path=anchor(c.checkpoint_path)) for c in contracts]
    spark = SparkSession.builder.appName("sluice.run").getOrCreate()
    ensure_checkpoint_dir(spark)
    for c in sorted(contracts, key=lambda c: c.name):
        if args.incremental:
            r = ingest_incremental(spark, c, landing_root=args.landing_root)
            news = "no new files" if r.no_new_files else f"{r.rows_added} rows added in {r.n_batches} micro-batches"
            print(f"{c.name}: {news}; total {r.total_rows}")
            if args.optimize:
                packed = compact_bronze(spark, c.bronze_path).agg(F.sum("files_replaced")).first()[0] or 0
                print(f"{c.name}: {packed} small files packed")
            table, files = read_bronze(spark, c.bronze_path), live_files(spark, c.bronze_path)
        else:
            r = ingest_full_refresh(spark, c, landing_root=args.landing_root)
            print(f"{c.name}: wrote {r.rows} rows (run {r.run_id})")
            if args.optimize and c.partition_by:
                maintain.compact(spark, c.bronze_path, c.partition_by[0])
            if args.optimize and c.zorder_by:
                maintain.optimize_source(spark, c, f"{c.bronze_path.rstrip('/')}__clustered")
            table, files = spark.read.parquet(c.bronze_path), file_inventory(spark, c.bronze_path)
        if c.aggregate_rules:
            report = evaluate_rules(table, list(c.aggregate_rules), extra_views={"bronze_files": files})
            print(format_report(enforce(report)))
        if c.row_rules or c.dedup_key:
            done = refine(spark, c, table)
            print(f"{c.name}: {done.clean} clean, {done.rejects} rejected, Silver {done.silver}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
