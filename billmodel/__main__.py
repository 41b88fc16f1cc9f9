"""Command line: build, refresh and check the wide cost table.

    python -m billmodel build --cur s3://bucket/cur --out s3://bucket/wide
    python -m billmodel build --cur ... --out ... --months 2024-05 2024-06
    python -m billmodel refresh --cur ... --out ... [--watch]
    python -m billmodel check --cur ... [--wide s3://bucket/wide] [--out s3://bucket/checks]
    python -m billmodel publish --cur ... --out s3://bucket/tables [--database bb]
    python -m billmodel partitions --table bb.cur
    python -m billmodel dictionaries --cur ... --out s3://bucket/dims

The session comes from ``spark-submit`` / the cluster configuration.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .model import CostModel
from .plans.quality import Observed
from .plans.views import publish_tables
from .sources.cur import read_cur, refresh_partitions
from .sources.dictionaries import write_dictionary
from .sources.sink import read_wide_table, write_wide_table
from .streaming.refresh import refresh_changes, refresh_months, watch_changes


def _options(a: argparse.Namespace) -> dict:
    return {"fill_unused": a.fill_unused, "fee_grain": a.fee_grain, "rds_only": a.rds_only, "all_names": a.all_names}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="billmodel")
    sub = p.add_subparsers(dest="cmd", required=True)
    p_partitions = sub.add_parser("partitions", help="register a catalog table's new month folders")
    p_partitions.add_argument("--table", required=True)
    for name in ("build", "refresh", "check", "publish", "dictionaries"):
        s = sub.add_parser(name)
        s.add_argument("--cur", required=True, help="path of the Parquet cost-and-usage export")
        s.add_argument("--fill-unused", action="store_true",
                       help="a day without savings-plan usage counts as 0 used (default: NULL leftover)")
        s.add_argument("--fee-grain", choices=["row", "group"], default="row",
                       help="subtract usage per fee row (model default) or per summed commitment period")
        s.add_argument("--rds-only", action="store_true", help="fill the RDS columns on AmazonRDS lines only")
        s.add_argument("--all-names", action="store_true", help="a line for every name of its clusters (default: one name)")
        if name != "check":
            s.add_argument("--out", required=True, help="output folder (wide table, tables or dictionaries)")
        if name in ("build", "refresh"):
            s.add_argument("--table", help="also name the wide table in the catalog")
        if name == "build":
            s.add_argument("--months", nargs="*", help="rebuild only these yyyy-MM months")
        if name == "refresh":
            s.add_argument("--checkpoint", help="folder of the record of files (default: under spark.checkpoint.dir)")
            s.add_argument("--watch", action="store_true", help="keep polling instead of one pass")
        if name == "check":
            s.add_argument("--wide", help="read the written wide table instead of rebuilding it")
            s.add_argument("--out", help="also write every check's rows here, as Parquet")
        if name == "publish":
            s.add_argument("--database", help="catalog database of the tables (default: the current one)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"billmodel-{a.cmd}").getOrCreate()
    if a.cmd == "partitions":
        refresh_partitions(spark, a.table)
        return
    opts = _options(a)

    if a.cmd == "build":
        if a.months:
            refresh_months(spark, a.cur, a.out, a.months, table=a.table, **opts)
        else:
            observed, model = Observed(), CostModel(read_cur(spark, a.cur), **opts)
            write_wide_table(model.observed_wide(observed), a.out, table=a.table, counted=model.unnamed_wide)
            print("== total: bb_bwt_cost_total, cur_unblended_total, diff", *observed.totals(), sep=" | ")
            print("== savings plans: a_total, b_total, diff", *observed.savings_plans(), sep=" | ")
    elif a.cmd == "refresh":
        refresh = watch_changes if a.watch else refresh_changes
        refresh(spark, a.cur, a.out, state=a.checkpoint, table=a.table, **opts)
    elif a.cmd == "publish":
        for name in publish_tables(CostModel(read_cur(spark, a.cur), **opts), a.out, a.database, a.cur):
            print(name)
    elif a.cmd == "check":
        wide = read_wide_table(spark, a.wide) if a.wide else None
        m = CostModel(read_cur(spark, a.cur), wide=wide, **opts)
        totals = m.totals()
        for title, df in [("key", m.key_check()), *totals.checks().items()]:
            if a.out:
                df.write.mode("overwrite").parquet(os.path.join(a.out, title.replace(" ", "_")))
            print(f"== {title}: {', '.join(df.columns)}")
            count = 0
            for count, row in enumerate(df.toLocalIterator(), 1):  # all rows, a partition at a time
                print(*row, sep=" | ")
            print(f"-- {count} rows")
        totals.unpersist()
    elif a.cmd == "dictionaries":
        m = CostModel(read_cur(spark, a.cur), **opts)
        write_dictionary(m.dict_line_item_type(), os.path.join(a.out, "line_item_line_item_type"))
        write_dictionary(m.dict_usage_type(), os.path.join(a.out, "line_item_usage_type"))


if __name__ == "__main__":
    main()
