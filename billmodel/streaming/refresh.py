"""A2 + A4 incrementally: rebuild the months whose export files changed, from the
files that hold them.

An integrated export overwrites its files under the same names as a month is
restated, and removes them when a month is withdrawn. A refresh compares the
export's file list (path, length, modification time) with the list recorded by the
refresh before; where nothing changed it ends there, without a row of the bill.
Otherwise the changed files are read once for their *facts* (``facts_of``): the
months they hold, the cluster names, the months of each cluster, what usage of each
commitment cost. Facts are kept by file, so a changed or removed file's are taken
back as the new ones are added, and everything that reaches beyond a month comes
from them:

* the months to rebuild: those of changed and removed files, before and after, and
  those with lines of a cluster that now has another name;
* the files to read: those that hold one of these months, no others;
* the cluster names and the commitments' totals of the whole bill.

All months change in one step (``sources.sink``). The record lives in a folder of
its own for each export and wide table, under the cluster's
``spark.checkpoint.dir``; a new one is completed after the table is written, so a
refresh that fails is done again by the next one, with the same result. A record
lists every file with its schema and the record that has its facts; facts are
rewritten together after ``MOST_ENTRIES`` records.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import commitments, emr, facets
from ..operators.base import base_costs, keyed
from ..operators.wide import wide_costs
from ..session import shared_folder
from ..sources import files
from ..sources.cur import conform, merging_groups, read_cur, united
from ..sources.sink import write_wide_table

START = "line_item_usage_start_date"
SAME = ["path", "file", "length", "modified"]
FILES = "path string, file string, length long, modified long, schema string, entry long"
FACTS = "file string, fact string, a string, b string, c string, month string, lines long, used decimal(38,18)"
FILE_COLUMNS = [x.split(" ")[0] for x in FILES.split(", ")]
#: Records whose facts are read side by side, at most; then they are put together.
MOST_ENTRIES = 12
COMPLETE = "complete.json"


# --- months -----------------------------------------------------------------------


def _month_range(month: str) -> tuple[str, str]:
    first = dt.datetime.strptime(month + "-01", "%Y-%m-%d")
    nxt = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return first.strftime("%Y-%m-%d %H:%M:%S"), nxt.strftime("%Y-%m-%d %H:%M:%S")


def months_filter(months: list[str | None]):
    """Usage-start ranges of the given 'yyyy-MM' months (pushed to the scan);
    None stands for lines without a start."""
    ranges = [F.col(START).isNull() if m is None else
              (F.col(START) >= F.lit(_month_range(m)[0]).cast("timestamp_ntz")) & (F.col(START) < F.lit(_month_range(m)[1]).cast("timestamp_ntz"))
              for m in months]
    return reduce(lambda x, y: x | y, ranges)


def wide_for_months(bill: DataFrame, months: list[str | None], emr_names: DataFrame | None = None, **options) -> DataFrame:
    """Wide-table rows of the given months only; cluster names (unless given as
    a table) from the whole bill."""
    bill = conform(bill)
    names = emr.cluster_name_by_id(base_costs(bill)) if emr_names is None else emr_names
    return wide_costs(base_costs(bill.where(months_filter(months))), emr_names=names, **options)


def refresh_months(spark: SparkSession, cur_path: str, wide_path: str, months: list[str | None], *, bill: DataFrame | None = None,
                   emr_names: DataFrame | None = None, table: str | None = None, balance: bool = True, **options) -> None:
    """Replace ``months`` of the wide table by those of the bill (of ``bill``, where
    only the files that hold them are to be read), all in one step; those that it
    has no row of are dropped."""
    if not months:
        return
    rows = wide_for_months(read_cur(spark, cur_path) if bill is None else bill, months, emr_names, **options)
    write_wide_table(rows, wide_path, mode="months", table=table, months=months, balance=balance)


# --- facts of files ---------------------------------------------------------------


def facts_of(lines: DataFrame) -> DataFrame:
    """Facts of each ``file`` of conformed lines, in one pass: a row for each that
    differs, with its number of lines and the sum of costs.

    ``month``: lines start in it. ``name``: a cluster (a) has a name (b).
    ``cluster``: a cluster (a) has lines in the month. ``used``: usage of a
    commitment (kind a, arn b) in a period (c) cost so much. All but the first are
    of final lines only."""
    fee, other = facets.emr_fee(), facets.emr_other()
    month = F.coalesce("_bb_usage_year_month", F.lit(""))
    final = F.coalesce(F.col("bill_invoice_id") != "", F.lit(False))
    typ = F.col("line_item_line_item_type")
    kind = F.coalesce(*[F.when(typ == usage, k) for k, (_, usage, *_) in commitments.KINDS.items()])
    none = F.lit(None).cast("string")

    def fact(when, name: str, a=none, b=none, c=none, used=None):
        value = F.lit(None).cast("decimal(38,18)") if used is None else used.cast("decimal(38,18)")
        return F.when(when, F.struct(F.lit(name).alias("fact"), a.alias("a"), b.alias("b"), c.alias("c"),
                                     (none if name == "name" else month).alias("month"), value.alias("used")))

    named = fee.predicate & (F.col("resource_tags_user_name") != "")
    fee_id, tag_id = fee.columns["bb_emr_cluster_id"], other.columns["bb_emr_cluster_id"]
    rows = keyed(lines).withColumn("kind", kind)
    rows = rows.withColumns({"arn": commitments.by_kind(lambda k: F.col(commitments.KINDS[k][2])), "period": commitments.period()})
    found = F.array(
        fact(F.lit(True), "month"),
        fact(final & named & fee_id.isNotNull(), "name", fee_id, F.col("resource_tags_user_name")),
        fact(final & fee.guard & fee_id.isNotNull(), "cluster", fee_id),
        fact(final & other.guard & tag_id.isNotNull(), "cluster", tag_id),
        fact(final & F.col("kind").isNotNull(), "used", F.col("kind"), F.col("arn"), F.col("period"), commitments.usage_cost()))
    facts = rows.select("file", F.explode(F.array_compact(found)).alias("x")).select("file", "x.*")
    out = facts.groupBy("file", "fact", "a", "b", "c", "month").agg(F.count(F.lit(1)).alias("lines"), F.sum("used").alias("used"))
    return out.select(*[F.col(n).cast(t).alias(n) for n, t in (x.split(" ", 1) for x in FACTS.split(", "))])


def names_of(facts: DataFrame) -> DataFrame:
    """One name per cluster id, the smallest (as ``emr.cluster_name_by_id``)."""
    return facts.where("fact = 'name'").groupBy(F.col("a").alias("bb_emr_cluster_id")).agg(F.min("b").alias("bb_emr_cluster_name"))


def totals_of(facts: DataFrame) -> DataFrame:
    """Commitments' totals (as ``commitments.used_totals``)."""
    some = facts.where("fact = 'used'")
    return some.groupBy(F.col("a").alias("kind"), F.col("b").alias("arn"), F.col("c").alias("period")).agg(F.sum("used").alias("used"))


# --- records ----------------------------------------------------------------------


def state_folder(spark: SparkSession, cur_path: str, wide_path: str) -> str:
    """The record's folder: of its own for each export and wide table."""
    pair = hashlib.sha256(f"{cur_path.rstrip('/')}\n{wide_path.rstrip('/')}".encode()).hexdigest()[:20]
    return f"{shared_folder(spark).rstrip('/')}/billmodel-refresh-{pair}"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete records in the folder."""
    return sorted(int(n) for n in files.children(spark, folder) if n.isdigit() and files.exists(spark, f"{folder}/{n}/{COMPLETE}"))


def list_files(spark: SparkSession, cur_path: str) -> DataFrame:
    """(path, file, length, modified) of the export's files; contents are not read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(cur_path))
    return found.select("path", F.col("_metadata.file_path").alias("file"), F.col("length"),
                        F.unix_micros("modificationTime").alias("modified"))


class Record:
    """What the refresh before saw (nothing, before the first)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        versions = _versions(spark, folder)
        self.number = versions[-1] if versions else 0
        self.entries = json.loads(files.read_text(spark, f"{folder}/{self.number}/{COMPLETE}"))["entries"] if versions else []
        self.files = spark.read.schema(FILES).parquet(f"{folder}/{self.number}/files") if versions else spark.createDataFrame([], FILES)

    def facts(self, of: DataFrame) -> DataFrame:
        """Facts of some of its files."""
        if not self.entries:
            return self.spark.createDataFrame([], FACTS)
        parts = [self.spark.read.schema(FACTS).parquet(f"{self.folder}/{n}/facts").withColumn("entry", F.lit(n).cast("long")) for n in self.entries]
        return reduce(DataFrame.union, parts).join(of.select("file", "entry"), ["file", "entry"], "left_semi").drop("entry")

    def clear(self, keep: int = 2) -> None:
        """Remove what neither of the last ``keep`` records needs."""
        versions = _versions(self.spark, self.folder)
        needed = set(versions[-keep:])
        for n in versions[-keep:]:
            needed |= set(json.loads(files.read_text(self.spark, f"{self.folder}/{n}/{COMPLETE}"))["entries"])
        for name in files.children(self.spark, self.folder):
            if name.isdigit() and int(name) < versions[-1] and int(name) not in needed:
                files.delete(self.spark, f"{self.folder}/{name}")


def bill_of(spark: SparkSession, cur_path: str, listed: list[tuple[str, str]], schemas: list[str]) -> DataFrame:
    """The bill's lines in some files, (path, schema) each, in the columns and
    types that all its files (of ``schemas``) have together."""
    parts = []
    for schema in schemas:
        kind = StructType.fromJson(json.loads(schema))
        some = [path for path, s in listed if s == schema]
        parts.append(read_cur(spark, cur_path, schema=kind, files=some) if some else conform(spark.createDataFrame([], kind)))
    return united(parts)


def _with_schemas(spark: SparkSession, cur_path: str, paths: list[str]) -> list[tuple[str, str]]:
    """(path, schema) of files, those whose schemas merge under the merged one."""
    out = []
    for some in merging_groups(spark, cur_path, paths):
        schema = spark.read.option("basePath", cur_path).option("mergeSchema", "true").parquet(*some).schema.json()
        out += [(p, schema) for p in some]
    return out


# --- the refresh ------------------------------------------------------------------


def refresh_changes(spark: SparkSession, cur_path: str, wide_path: str, *, state: str | None = None,
                    table: str | None = None, **options) -> list[str | None]:
    """Rebuild the months of all files that were added, changed or removed since
    the last refresh; returns these months."""
    cur_path = cur_path.rstrip("/")
    folder = state or state_folder(spark, cur_path, wide_path)
    record = Record(spark, folder)
    before, now = record.files, list_files(spark, cur_path)
    # The driver lists an export's files to read them; here it lists the changed ones.
    differ = now.withColumn("here", F.lit(True)).join(before.withColumn("known", F.lit(True)), SAME, "full").where("here IS NULL OR known IS NULL").collect()
    new, gone = [r for r in differ if r["here"]], [r for r in differ if r["known"]]
    if not differ and record.number:
        return []
    gone = spark.createDataFrame([tuple(r[c] for c in FILE_COLUMNS) for r in gone], FILES)
    number, kept = record.number + 1, before.join(gone.select(*SAME), SAME, "left_anti")
    target = f"{folder}/{number}"
    files.delete(spark, target)  # of a refresh that failed
    known = dict(_with_schemas(spark, cur_path, [r["path"] for r in new]) if new else [])
    added = spark.createDataFrame([(*(r[c] for c in SAME), known[r["path"]], number) for r in new], FILES)
    some = [(r["path"], known[r["path"]]) for r in new]
    if some:
        lines = [conform(spark.read.schema(StructType.fromJson(json.loads(s))).option("basePath", cur_path)
                         .parquet(*[p for p, x in some if x == s]).select("*", F.col("_metadata.file_path").alias("file"))) for s in sorted(set(known.values()))]
        fresh = facts_of(united(lines))
    else:
        fresh = spark.createDataFrame([], FACTS)
    together = len(record.entries) >= MOST_ENTRIES
    (fresh.unionByName(record.facts(kept)) if together else fresh).write.mode("overwrite").parquet(f"{target}/facts")
    written = spark.read.schema(FACTS).parquet(f"{target}/facts")
    fresh = written.join(F.broadcast(added.select("file")) if len(new) < 10_000 else added.select("file"), "file", "left_semi")
    old, stays = record.facts(gone).persist(), record.facts(kept)
    after = stays.unionByName(fresh).persist()
    months = {r[0] for r in old.unionByName(fresh).where("fact = 'month'").select("month").distinct().collect()}
    if record.number:
        months |= {r[0] for r in _months_with(after, _renamed(old.unionByName(fresh), record.facts(before), after)).collect()}
    wanted = sorted((m or None for m in months), key=lambda m: m or "")
    every = kept.unionByName(added)
    schemas = sorted(r[0] for r in every.select("schema").distinct().collect())
    holds = after.where("fact = 'month'").where(F.col("month").isin(sorted(months))).groupBy("file").agg(F.count(F.lit(1)).alias("held"))
    listed = every.join(holds, "file").select("path", "schema", "held").collect()
    if wanted:
        bill = bill_of(spark, cur_path, sorted((r["path"], r["schema"]) for r in listed), schemas) if schemas else conform(spark.createDataFrame([], f"{START} timestamp_ntz"))
        refresh_months(spark, cur_path, wide_path, wanted, bill=bill, emr_names=names_of(after), used=totals_of(after), table=table,
                       balance=sum(r["held"] for r in listed) > 2 * len(listed), **options)
    every = every.withColumn("entry", F.lit(number).cast("long")) if together else every
    every.select(*FILE_COLUMNS).write.mode("overwrite").parquet(f"{target}/files")
    entries = sorted(r[0] for r in spark.read.schema(FILES).parquet(f"{target}/files").select("entry").distinct().collect())
    files.write_once(spark, f"{target}/{COMPLETE}", json.dumps({"entries": entries}), f".draft-{uuid.uuid4().hex}")
    record.clear()
    old.unpersist(), after.unpersist()
    return wanted


def _renamed(touched: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids of clusters whose name is new, gone or another; only those with a name
    in ``touched`` facts can be."""
    ids = touched.where("fact = 'name'").select("a").distinct()
    was, now = (names_of(x.join(ids, "a", "left_semi")) for x in (before, after))
    both = was.withColumnRenamed("bb_emr_cluster_name", "was").join(now, "bb_emr_cluster_id", "full")
    return both.where(~F.col("was").eqNullSafe(F.col("bb_emr_cluster_name"))).select("bb_emr_cluster_id")


def _months_with(facts: DataFrame, clusters: DataFrame) -> DataFrame:
    """Months that have lines of the given clusters, by either id."""
    held = facts.where("fact = 'cluster'").select(F.col("a").alias("bb_emr_cluster_id"), "month")
    return held.join(clusters, "bb_emr_cluster_id", "left_semi").select("month").distinct()


def watch_changes(spark: SparkSession, cur_path: str, wide_path: str, interval_seconds: float = 3600, **options) -> None:
    """Refresh again and again, ``interval_seconds`` apart."""
    while True:
        refresh_changes(spark, cur_path, wide_path, **options)
        time.sleep(interval_seconds)
