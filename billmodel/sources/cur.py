"""Reading the cost-and-usage export (A1, A2, A3).

Types are enforced: money and amounts that are not DECIMAL become
``MONEY`` (wide enough for any amount of a bill; a value beyond it is an error,
never cut off), and times become zone-less UTC, whatever the session's zone: by
their epoch count, or for texts by the offset that they state (none: UTC).
DECIMAL columns keep their own scale.

The export is schema-on-read and service dependent: accounts without reserved
instances have no reservation columns, tags appear only once activated. The
model reads a fixed subset of columns; ``conform`` adds any of them that are
missing as typed NULL columns so the rest of the plan never fails on a
narrower export. All other columns pass through untouched.
"""

from __future__ import annotations

import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

# The bill columns the model reads, with the type used when a
# column is absent from an export.
REQUIRED_COLUMNS: dict[str, str] = {
    "bill_invoice_id": "string",
    "bill_billing_entity": "string",
    "identity_line_item_id": "string",
    "line_item_usage_start_date": "timestamp_ntz",
    "line_item_usage_end_date": "timestamp_ntz",
    "line_item_usage_account_id": "string",
    "line_item_line_item_type": "string",
    "line_item_product_code": "string",
    "line_item_usage_type": "string",
    "line_item_operation": "string",
    "line_item_resource_id": "string",
    "line_item_usage_amount": "double",
    "line_item_unblended_cost": "double",
    "line_item_line_item_description": "string",
    "line_item_legal_entity": "string",
    "pricing_lease_contract_length": "string",
    "product_product_family": "string",
    "product_product_name": "string",
    "product_region": "string",
    "product_region_code": "string",
    "product_servicecode": "string",
    "product_transfer_type": "string",
    "product_instance_type": "string",
    "product_instance_type_family": "string",
    "product_vcpu": "string",
    "product_physical_processor": "string",
    "product_volume_api_name": "string",
    "product_volume_type": "string",
    "product_database_engine": "string",
    "product_deployment_option": "string",
    "reservation_reservation_a_r_n": "string",
    "reservation_effective_cost": "double",
    "savings_plan_savings_plan_a_r_n": "string",
    "savings_plan_savings_plan_effective_cost": "double",
    "savings_plan_purchase_term": "string",
    "resource_tags_user_name": "string",
    "resource_tags_aws_elasticmapreduce_job_flow_id": "string",
    "resource_tags_aws_elasticmapreduce_instance_group_role": "string",
}

MONEY = "decimal(38,12)"

# The tag the department analyses group on (activated by the user).
DEPARTMENT_TAG = "resource_tags_user_department"


def conform(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Every required column the export lacks as a typed NULL column, and the
    others in the model's types."""
    wanted = dict(REQUIRED_COLUMNS)
    wanted.update(extra or {DEPARTMENT_TAG: "string"})
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = [_typed(n, kinds[n], wanted.get(n)).alias(n) for n in df.columns]
    missing = [F.lit(None).cast(MONEY if t == "double" else t).alias(n) for n, t in wanted.items() if n not in kinds]
    return df.select(*out, *missing)


def utc(instant: Column) -> Column:
    """The zone-less UTC time of an instant, counted from the epoch: the session's
    zone, which has one hour twice and lacks another every year, has no part in it."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


# A time's offset from UTC, at the end of its text.
OFFSET = r"(Z|[+-][0-9]{1,2}(:?[0-9]{2}){0,2})\s*$"
CLOCK_AND_OFFSET = r"[0-9]:[0-9]{1,2}(:[0-9.]+)?\s*" + OFFSET


def _typed(name: str, kind: T.DataType, wanted: str | None) -> Column:
    c = F.col(f"`{name}`")
    if wanted == "double" and not isinstance(kind, T.DecimalType):
        return c.cast(MONEY)
    if wanted == "timestamp_ntz" and isinstance(kind, T.TimestampType):
        return utc(c)
    if wanted == "timestamp_ntz" and isinstance(kind, T.StringType):
        text = F.nullif(F.trim(c), F.lit(""))
        stated = F.regexp_replace(F.regexp_replace(text, r"\s+([+-])", "$1"), r"([T ][0-9]{1,2}:[0-9]{1,2})([+-]|Z)", "$1:00$2")  # 21:30Z
        stated = F.regexp_replace(stated, r"(:[0-9.]+[+-][0-9]{1,2})$", "$1:00")  # -08
        return F.when(text.rlike(CLOCK_AND_OFFSET), utc(stated.cast("timestamp"))).otherwise(text.cast("timestamp_ntz"))
    return c


def read_cur(spark: SparkSession, path: str, *, merge_schema: bool = True, schema: StructType | str | None = None,
             files: list[str] | None = None) -> DataFrame:
    """A1: scan the exported Parquet bill (directory partitions are discovered).

    The export gains columns over time, so file schemas are merged by
    default; a fixed ``schema`` (or ``merge_schema=False``) skips reading every
    file footer up front. Where files store a column in types that don't merge
    (a price as DOUBLE, later as DECIMAL), they are read in groups that do, each
    cast, and united. ``files`` reads only these files of the export.
    """
    paths = [path] if files is None else files
    reader = _reader(spark, path, paths)
    if schema is not None:
        return conform(reader.schema(schema).parquet(*paths))
    if not merge_schema:
        return conform(reader.parquet(*paths))
    return united([conform(_merged(spark, path, some)) for some in merging_groups(spark, path, paths)])


def _reader(spark: SparkSession, path: str, paths: list[str]) -> DataFrameReader:
    """Partition columns come from the folders below the export's."""
    return spark.read if paths == [path] else spark.read.option("basePath", path)


def _merged(spark: SparkSession, path: str, paths: list[str]) -> DataFrame:
    return _reader(spark, path, paths).option("mergeSchema", "true").parquet(*paths)


def merges(spark: SparkSession, path: str, paths: list[str]) -> bool:
    """Whether the files' schemas merge (Spark reads their footers side by side)."""
    try:
        _merged(spark, path, paths)
        return True
    except (Py4JJavaError, PySparkException) as e:
        if not any(f"[{c}]" in str(e) for c in NOT_MERGING):
            raise
        return False


# Error conditions of schemas that don't merge.
NOT_MERGING = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def merging_groups(spark: SparkSession, path: str, paths: list[str]) -> list[list[str]]:
    """The paths' files in groups whose schemas merge, the paths if all do. Files
    are halved in the order in which they were written (then of their names), in
    which an export changes its types once in a while, so there are few groups,
    found in few steps; parts of equal schemas are put together again, and others
    that merge."""
    if merges(spark, path, paths):
        return [paths]
    names = paths if paths != [path] else spark.read.option("mergeSchema", "false").parquet(path).inputFiles()
    written = _written(spark, names)

    def cut(some: list[str]) -> list[list[str]]:
        if len(some) == 1 or merges(spark, path, some):
            return [some]
        return cut(some[: len(some) // 2]) + cut(some[len(some) // 2 :])

    alike: dict[str, list[str]] = {}
    for some in cut(sorted(names, key=lambda n: (written.get(_plain(n), 0), n))):
        alike.setdefault(_merged(spark, path, some).schema.json(), []).extend(some)
    groups: list[list[str]] = []
    for some in sorted(sorted(a) for a in alike.values()):
        fits = next((g for g in groups if merges(spark, path, [g[0], g[-1], some[0], some[-1]]) and merges(spark, path, g + some)), None)
        if fits is None:
            groups.append(some)
        else:
            fits += some
    return groups


def _plain(path: str) -> str:
    """A path as both forms that Spark gives it in: ``file:/a`` and ``file:///a``."""
    return re.sub(r"^file:/+", "file:/", path)


def _written(spark: SparkSession, names: list[str]) -> dict[str, int]:
    """When files were written; contents are not read."""
    found = spark.read.format("binaryFile").load(names).select(F.col("_metadata.file_path").alias("file"), "path", F.unix_micros("modificationTime").alias("at"))
    return {_plain(p): r["at"] for r in found.collect() for p in (r["file"], r["path"])}


def united(parts: list[DataFrame]) -> DataFrame:
    """Conformed parts of a bill as one: a column that they store in different
    types becomes the widest number, else text."""
    if len(parts) == 1:
        return parts[0]
    kinds: dict[str, list[T.DataType]] = {}
    for p in parts:
        for f in p.schema.fields:
            some = kinds.setdefault(f.name, [])
            if f.dataType not in some and not isinstance(f.dataType, T.NullType):
                some.append(f.dataType)
    to = {n: _common(some) for n, some in kinds.items() if len(some) > 1}
    typed = [p.select(*[(F.col(f"`{n}`").cast(to[n]) if n in to else F.col(f"`{n}`")).alias(n) for n in p.columns]) for p in parts]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), typed)


def _common(kinds: list[T.DataType]) -> T.DataType:
    if all(isinstance(k, T.DecimalType) for k in kinds):
        scale, whole = max(k.scale for k in kinds), max(k.precision - k.scale for k in kinds)
        return T.DecimalType(min(38, scale + whole), scale)
    if all(isinstance(k, T.NumericType) for k in kinds):
        if any(isinstance(k, T.DecimalType) for k in kinds) and not any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
            return T.DecimalType(38, max(k.scale for k in kinds if isinstance(k, T.DecimalType)))
        return T.DoubleType() if any(isinstance(k, T.FractionalType) for k in kinds) else T.LongType()
    return T.StringType()


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """A2: register partitions added under a catalog table (a new billing month).

    Path-based reads discover directories on every scan, so this is only
    needed for tables registered in a catalog.
    """
    spark.catalog.recoverPartitions(table)


def finalised(bill: DataFrame) -> DataFrame:
    """A3: keep finalised lines. Blank invoice ids are not final (possible
    duplicates); NULL ids drop as well, as a comparison with NULL is not true."""
    return bill.where(F.col("bill_invoice_id") != "")
