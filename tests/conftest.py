from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from billmodel.sources.fixture import BILL_COLUMNS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

DECIMAL_COLUMNS = {"line_item_usage_amount", "line_item_unblended_cost", "reservation_effective_cost",
                   "savings_plan_savings_plan_effective_cost"}
TIMESTAMP_COLUMNS = {"line_item_usage_start_date", "line_item_usage_end_date"}


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("billmodel-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="billmodel-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def bill_schema() -> T.StructType:
    fields = []
    for n in BILL_COLUMNS:
        if n in DECIMAL_COLUMNS:
            t = T.DecimalType(18, 6)
        elif n in TIMESTAMP_COLUMNS:
            t = T.TimestampNTZType()
        else:
            t = T.StringType()
        fields.append(T.StructField(n, t, True))
    return T.StructType(fields)


_counter = iter(range(1, 10**9))


def line(**kw) -> dict:
    """One bill line: blanks for strings, NULL for money, given values win."""
    row = {n: "" for n in BILL_COLUMNS}
    for n in DECIMAL_COLUMNS:
        row[n] = None
    row.update(
        identity_line_item_id=f"line-{next(_counter)}",
        line_item_usage_start_date=dt.datetime(2024, 1, 1, 0, 0, 0),
        line_item_usage_end_date=dt.datetime(2024, 1, 1, 1, 0, 0),
        bill_invoice_id="INV-1",
        bill_billing_entity="AWS",
        line_item_line_item_type="Usage",
        line_item_usage_amount=Decimal("1"),
        line_item_unblended_cost=Decimal("1"),
        product_region="China (Ningxia)",
        product_region_code="cn-northwest-1",
        resource_tags_user_department=None,
    )
    for k, v in kw.items():
        if k in DECIMAL_COLUMNS and v is not None and not isinstance(v, Decimal):
            v = Decimal(str(v))
        row[k] = v
    return row


def make_bill(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r[n] for n in BILL_COLUMNS) for r in rows], bill_schema())
