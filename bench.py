"""Bench: the model over a bill derived from ``$BENCH_SF_DIR`` (default sf0.1).

Setup (not timed): the bill is derived from the whole ``lineitem`` table and
written once as Parquet, the shape of a cost-and-usage export. Timed: the
wide-table build (one job writing month partitions), then the reports,
checks and analyses over the written wide table, as users query it. Each
query runs once to warm up and then ``$BENCH_RUNS`` times (default 3); the
median is reported. Prints one JSON line.

For reference, ``baseline`` holds two other ways to the same table from the same
bill Parquet: on Spark, the bill with every facet's view joined back to it
(``tools/facet_joins.py``), and in DuckDB, with the same thread count, a plain
projection in one pass (``tools/duckdb_projection.py``). Neither is part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from billmodel import CostModel, read_cur  # noqa: E402
from billmodel.operators.wide import PARTITION_COLUMN  # noqa: E402
from billmodel.session import local_session  # noqa: E402
from billmodel.sources.fixture import lineitem_bill  # noqa: E402
from billmodel.sources.sink import read_wide_table, write_wide_table  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def duckdb_projection(cur_path: str, out_dir: str, cpus: int, runs: int) -> float | None:
    try:
        import duckdb
    except ImportError:
        return None
    from tools.duckdb_projection import projection

    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    sql = projection(f"read_parquet('{cur_path}/*.parquet')")
    samples = []
    for i in range(runs + 1):
        t0 = time.perf_counter()
        con.execute(f"COPY ({sql}) TO '{out_dir}/duck-{i}' (FORMAT parquet, PARTITION_BY (bb_usage_year_month))")
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples[1:]), 3)


def spark_facet_joins(spark, bill, out_dir: str) -> float:
    """The bill with every facet joined back, written alike (one warm-up,
    one timed run: it is the slow side of the comparison)."""
    from tools.facet_joins import join_every_facet

    samples = []
    for i in range(2):
        t0 = time.perf_counter()
        joined = join_every_facet(CostModel(bill)).withColumnRenamed("_bb_usage_year_month", PARTITION_COLUMN)
        write_wide_table(joined, os.path.join(out_dir, f"join-form-{i}"))
        samples.append(time.perf_counter() - t0)
    return round(samples[-1], 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="billmodel-bench-")
    cur_path = os.path.join(scratch, "cur")
    # An export arrives as many Parquet files; write the derived bill so.
    lineitem_bill(spark, sf_dir).repartition(int(cpus) * 2).write.mode("overwrite").parquet(cur_path)
    bill = read_cur(spark, cur_path)

    builds = iter(range(1_000_000))

    def build() -> str:
        path = os.path.join(scratch, f"wide-{next(builds)}")
        write_wide_table(CostModel(bill).wide, path)
        return path

    m = CostModel(bill, wide=read_wide_table(spark, build()))
    queries = {
        "wide_build": build,
        "ec2_hourly_usage": lambda: _noop(m.ec2_hourly_usage()),
        "qc_total": lambda: m.qc_total().collect(),
        "qc_by_service": lambda: m.qc_by_service().collect(),
        "qc_savings_plans": lambda: m.qc_savings_plans().collect(),
        "qc_reserved": lambda: m.qc_reserved().collect(),
        "key_check": lambda: m.key_check().collect(),
        "purchase_option_mix": lambda: m.analysis("purchase_option_mix").collect(),
        "monthly_cost": lambda: m.analysis("monthly_cost").collect(),
        "department_share": lambda: m.analysis("department_share").collect(),
        "s3_cost_by_level": lambda: m.analysis("s3_cost_by_level").collect(),
        "parent_service_rollup": lambda: m.analysis("parent_service_rollup").collect(),
        "commitment_utilisation": lambda: m.analysis("commitment_utilisation").collect(),
        "dict_usage_type": lambda: m.dict_usage_type().collect(),
    }
    times: dict[str, float] = {}
    for name, fn in queries.items():
        fn()
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    baseline = {}
    for key, run in (("spark_facet_joins_wide_build", lambda: spark_facet_joins(spark, bill, scratch)),
                     ("duckdb_projection_wide_build", lambda: duckdb_projection(cur_path, scratch, int(cpus), runs))):
        try:
            baseline[key] = run()
        except Exception as exc:  # a reference point must not cost the result line
            print(f"baseline {key} failed: {exc}", file=sys.stderr)
            baseline[key] = None
    print(json.dumps({
        "metric": "model_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "runs": runs,
        "baseline": baseline,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
