"""Month refresh from the changes of an export's files."""

from __future__ import annotations

import datetime as dt
import glob
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billmodel import CostModel
from billmodel.operators import commitments, emr
from billmodel.sources.fixture import lineitem_bill
from billmodel.sources.sink import read_wide_table
from billmodel.sources.cur import conform, read_cur
from billmodel.streaming import refresh
from billmodel.streaming.refresh import facts_of, names_of, refresh_changes, state_folder, totals_of, wide_for_months
from conftest import SF_SMALL, line, make_bill


def _month(col="line_item_usage_start_date"):
    return F.date_format(col, "yyyy-MM")


def test_wide_for_months_equals_full_build(spark):
    bill = lineitem_bill(spark, SF_SMALL)
    full = CostModel(bill).wide.where(F.col("bb_usage_year_month").isin("2024-02", "2024-03"))
    part = wide_for_months(bill, ["2024-02", "2024-03"])
    cols = ["bb_id", "bb_cost", "bb_emr_cluster_name", "bb_usage_year_month"]
    assert Counter(map(tuple, part.select(cols).collect())) == Counter(map(tuple, full.select(cols).collect()))


COLS = ["bb_id", "bb_cost", "bb_emr_cluster_name", "bb_usage_year_month"]


def _export(root, name, rows):
    """One export file under a fixed name, as an integrated export writes it."""
    parts = tempfile.mkdtemp(prefix="part-", dir=root)
    rows.coalesce(1).write.mode("overwrite").parquet(parts + "/p")
    os.makedirs(root + "/cur", exist_ok=True)
    os.replace(glob.glob(parts + "/p/*.parquet")[0], f"{root}/cur/{name}.parquet")


def _table(spark, path):
    return Counter(map(tuple, read_wide_table(spark, path).select(COLS).collect()))


def _rebuilt(spark, root):
    return Counter(map(tuple, CostModel(read_cur(spark, root + "/cur")).wide.select(COLS).collect()))


def test_refresh_follows_every_change(spark):
    """New, restated (same name), withdrawn and removed files, lines without a
    date: after each refresh the table equals a full rebuild."""
    root = tempfile.mkdtemp(prefix="refresh-")
    bill = lineitem_bill(spark, SF_SMALL).where(F.expr("pmod(xxhash64(identity_line_item_id), 4) = 0")).cache()
    months = {m: bill.where(_month() == m) for m in ("2024-01", "2024-02", "2024-03")}

    def refresh():
        changed = refresh_changes(spark, root + "/cur", root + "/wide")
        assert _table(spark, root + "/wide") == _rebuilt(spark, root)
        return changed

    _export(root, "a", months["2024-01"])
    _export(root, "b", months["2024-02"])
    assert refresh() == ["2024-01", "2024-02"]
    assert refresh() == []
    _export(root, "c", months["2024-03"])  # a new month
    assert "2024-03" in refresh()
    _export(root, "a", months["2024-01"].where("line_item_line_item_type <> 'Tax'"))  # restated under the same name
    assert "2024-01" in refresh()
    _export(root, "b", months["2024-02"].withColumn("bill_invoice_id", F.lit("")))  # withdrawn: nothing is final
    assert "2024-02" in refresh()
    assert "2024-02" not in {k[3] for k in _table(spark, root + "/wide")}
    os.remove(root + "/cur/c.parquet")
    assert "2024-03" in refresh()
    undated = months["2024-03"].limit(5).withColumn("line_item_usage_start_date", F.lit(None).cast("timestamp_ntz"))
    _export(root, "d", undated)
    assert None in refresh()
    bill.unpersist()


def _spoil(path):
    """Same name, length and time, but no bill: whoever opens it fails."""
    at, size = os.stat(path).st_mtime_ns, os.path.getsize(path)
    with open(path, "wb") as f:
        f.write(b"x" * size)
    os.utime(path, ns=(at, at))


def test_only_the_files_of_the_months_are_opened(spark):
    root = tempfile.mkdtemp(prefix="pruned-")
    emr = dict(line_item_product_code="ElasticMapReduce", resource_tags_user_name="one")
    rows = {m: [line(line_item_usage_start_date=dt.datetime(2024, m, 1)), line(**emr, line_item_usage_start_date=dt.datetime(2024, m, 2), line_item_resource_id=f"arn:cluster/j-{m}")]
            for m in (1, 2, 3)}
    for m in rows:
        _export(root, f"m{m}", make_bill(spark, rows[m]))
    assert refresh_changes(spark, root + "/cur", root + "/wide") == ["2024-01", "2024-02", "2024-03"]
    _spoil(root + "/cur/m1.parquet")
    _spoil(root + "/cur/m3.parquet")
    assert refresh_changes(spark, root + "/cur", root + "/wide") == []
    more = [line(line_item_usage_start_date=dt.datetime(2024, 2, 9), line_item_unblended_cost="7")]
    _export(root, "m2", make_bill(spark, rows[2] + more))
    assert refresh_changes(spark, root + "/cur", root + "/wide") == ["2024-02"]
    months = Counter(r.bb_usage_year_month for r in read_wide_table(spark, root + "/wide").collect())
    assert months == {"2024-01": 2, "2024-02": 3, "2024-03": 2}
    # a new name of a cluster of January needs January's file
    _export(root, "m4", make_bill(spark, [line(**emr | {"resource_tags_user_name": "a"}, line_item_usage_start_date=dt.datetime(2024, 4, 1), line_item_resource_id="arn:cluster/j-1")]))
    with pytest.raises(Exception):
        refresh_changes(spark, root + "/cur", root + "/wide")
    assert Counter(r.bb_usage_year_month for r in read_wide_table(spark, root + "/wide").collect()) == months
    _export(root, "m1", make_bill(spark, rows[1]))
    assert refresh_changes(spark, root + "/cur", root + "/wide") == ["2024-01", "2024-04"]
    assert {r.bb_emr_cluster_name for r in read_wide_table(spark, root + "/wide").where("bb_emr_cluster_id = 'j-1'").collect()} == {"a"}


def test_facts_add_up_to_the_bills_own(spark):
    bill = lineitem_bill(spark, SF_SMALL)
    base = CostModel(bill).base
    facts = facts_of(conform(bill).withColumn("file", F.concat(F.lit("f"), F.pmod(F.xxhash64("identity_line_item_id"), F.lit(5))))).cache()
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(names_of(facts)) == rows(emr.cluster_name_by_id(base).select("bb_emr_cluster_id", "bb_emr_cluster_name"))
    want = commitments.used_totals(base).select("kind", "arn", "period", F.col("used").cast("decimal(38,18)"))
    assert rows(totals_of(facts)) == rows(want)
    months = {r[0] for r in bill.select(_month()).distinct().collect()}
    assert {r[0] for r in facts.where("fact = 'month'").select("month").collect()} == {m or "" for m in months}
    assert facts.where("fact = 'month'").agg(F.sum("lines")).first()[0] == bill.count()
    facts.unpersist()


def test_records_are_put_together_and_failures_repeated(spark, monkeypatch):
    """Many records, a refresh that dies in every place, files of other types:
    the table still equals a rebuild."""
    root = tempfile.mkdtemp(prefix="records-")
    monkeypatch.setattr(refresh, "MOST_ENTRIES", 2)
    emr = dict(line_item_product_code="ElasticMapReduce", line_item_resource_id="arn:cluster/j-1")
    for n in range(5):
        rows = [line(line_item_usage_start_date=dt.datetime(2024, 1 + n % 3, 1 + n), line_item_unblended_cost=str(n)), line(**emr, resource_tags_user_name=f"n{9 - n}")]
        bill = make_bill(spark, rows)
        _export(root, f"f{n}", bill.withColumn("line_item_unblended_cost", F.col("line_item_unblended_cost").cast("double")) if n % 2 else bill)
        if n == 2:  # the record is not completed: the next refresh does it again
            with monkeypatch.context() as m:
                m.setattr(refresh.files, "write_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
                with pytest.raises(KeyboardInterrupt):
                    refresh_changes(spark, root + "/cur", root + "/wide", state=root + "/state")
        refresh_changes(spark, root + "/cur", root + "/wide", state=root + "/state")
        got = Counter((r.bb_id, float(r.bb_cost), r.bb_emr_cluster_name) for r in read_wide_table(spark, root + "/wide").collect())
        want = Counter((r.bb_id, float(r.bb_cost), r.bb_emr_cluster_name) for r in CostModel(read_cur(spark, root + "/cur")).wide.collect())
        assert got == want
    assert len([n for n in os.listdir(root + "/state") if n.isdigit()]) <= 5


def test_renamed_cluster_reaches_other_months(spark):
    root = tempfile.mkdtemp(prefix="rename-")
    emr = dict(line_item_product_code="ElasticMapReduce", line_item_resource_id="arn:cluster/j-1")
    jan = line(**emr)
    feb = line(**emr, line_item_usage_start_date=dt.datetime(2024, 2, 1))
    _export(root, "jan", make_bill(spark, [jan]))
    _export(root, "feb", make_bill(spark, [feb | {"resource_tags_user_name": "old"}]))
    refresh_changes(spark, root + "/cur", root + "/wide")
    _export(root, "feb", make_bill(spark, [feb | {"resource_tags_user_name": "new"}]))
    assert refresh_changes(spark, root + "/cur", root + "/wide") == ["2024-01", "2024-02"]
    assert {r.bb_emr_cluster_name for r in read_wide_table(spark, root + "/wide").collect()} == {"new"}


def test_records_of_two_exports_are_apart(spark):
    assert state_folder(spark, "/x/cur", "/x/wide") == state_folder(spark, "/x/cur/", "/x/wide/")
    assert len({state_folder(spark, c, w) for c in ("/x/cur", "/y/cur") for w in ("/x/wide", "/y/wide")}) == 4


def test_record_folder_is_stable(spark):
    """The folder that records live in is the configured checkpoint
    folder itself, not the per-application folder under it."""
    from billmodel.session import checkpoint_dir, shared_folder

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured
        assert checkpoint_dir(spark).rstrip("/").split("/")[-1] != configured.rstrip("/").split("/")[-1]
    else:
        assert shared_folder(spark) == checkpoint_dir(spark)
