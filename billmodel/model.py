"""``CostModel``: the whole model over one bill, as lazily composed DataFrames.

Nothing here is cached or collected: each property is a logical plan that
Catalyst optimises with whatever consumes it (column pruning reaches the
Parquet scan through the wide projection). The one eager step: building
``wide`` (or the EMR lookup) measures the size of the EMR cluster-name
dimension, to pick the join; reports that do not show the name use
``unnamed_wide`` and start nothing. Persist or write ``wide`` when several
reports share it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from .operators import commitments, emr, facets
from .operators.base import base_costs
from .operators.wide import wide_costs
from .plans import analyses, profile, quality, report
from .sources.cur import conform, finalised


class CostModel:
    def __init__(self, bill: DataFrame, *, fill_unused: bool = False, fee_grain: str = "row",
                 rds_only: bool = False, emr_broadcast_bytes: int | None = None, all_names: bool = False,
                 wide: DataFrame | None = None):
        """``wide`` may be the already written wide table (``sources.sink``);
        reports and checks then read it instead of rebuilding it."""
        self.bill = conform(bill)
        self.all_names = all_names
        self._given = wide is not None
        if wide is not None:
            self.__dict__["wide"] = self.__dict__["unnamed_wide"] = wide
        self.fill_unused = fill_unused
        self.fee_grain = fee_grain
        self.rds_only = rds_only
        self.emr_broadcast_bytes = emr_broadcast_bytes

    def with_options(self, **options) -> "CostModel":
        """The same bill under other options (``fill_unused``, ``fee_grain``,
        ``rds_only``, ``emr_broadcast_bytes``, ``all_names``)."""
        current = {"fill_unused": self.fill_unused, "fee_grain": self.fee_grain, "rds_only": self.rds_only,
                   "emr_broadcast_bytes": self.emr_broadcast_bytes, "all_names": self.all_names}
        current.update(options)
        return CostModel(self.bill, **current)

    # sources and base
    @cached_property
    def finalised(self) -> DataFrame:
        return finalised(self.bill)

    @cached_property
    def base(self) -> DataFrame:
        return base_costs(self.bill)

    def facet(self, name: str) -> DataFrame:
        if name == "rds":
            return facets.rds(self.rds_only).view(self.base)
        return facets.FACETS[name]().view(self.base)

    # commitments and dimensions
    def ri_monthly_used(self) -> DataFrame:
        return commitments.ri_monthly_used(self.base)

    @cached_property
    def ri_unused(self) -> DataFrame:
        return commitments.ri_unused(self.base, fee_grain=self.fee_grain)

    def sp_daily_used(self) -> DataFrame:
        return commitments.sp_daily_used(self.base)

    def sp_unused(self) -> DataFrame:
        return commitments.sp_unused(self.base, fill_unused=self.fill_unused, fee_grain=self.fee_grain)

    def emr_cluster_names(self) -> DataFrame:
        return emr.emr_cluster_names(self.base)

    def emr_name_lookup(self) -> DataFrame:
        return emr.emr_name_lookup(self.base, self.emr_broadcast_bytes, self.all_names)

    # the wide table
    @property
    def _wide_options(self) -> dict:
        return {"fill_unused": self.fill_unused, "fee_grain": self.fee_grain, "rds_only": self.rds_only}

    @cached_property
    def wide(self) -> DataFrame:
        return wide_costs(self.base, **self._wide_options, emr_broadcast_bytes=self.emr_broadcast_bytes, all_names=self.all_names)

    def observed_wide(self, observed: quality.Observed) -> DataFrame:
        """The wide table, with Q1 and Q3 taken as it is written."""
        lines = observed.lines(base_costs(self.bill))
        return observed.wide(wide_costs(self.base, **self._wide_options, emr_broadcast_bytes=self.emr_broadcast_bytes,
                                        all_names=self.all_names, lines=lines))

    @cached_property
    def unnamed_wide(self) -> DataFrame:
        """The wide table without the EMR cluster name, for all that does not
        read it: no name dimension, no lookup, nothing eager. (With ``all_names``
        a line has a row for each of its names, so the names are read.)"""
        return self.wide if self.all_names else wide_costs(self.base, **self._wide_options, with_names=False)

    # report, checks, profile
    def ec2_hourly_usage(self, by_account: bool = False) -> DataFrame:
        return report.ec2_hourly_usage(self.unnamed_wide, by_account)

    def qc_total(self) -> DataFrame:
        return quality.qc_total(self.unnamed_wide, self.bill)

    def qc_by_service(self) -> DataFrame:
        return quality.qc_by_service(self.unnamed_wide, self.bill)

    def qc_savings_plans(self) -> DataFrame:
        return quality.qc_savings_plans(self.unnamed_wide, self.bill)

    def qc_reserved(self) -> DataFrame:
        return quality.qc_reserved(self.unnamed_wide, self.base)

    def totals(self) -> quality.Totals:
        """Q1-Q4 from one pass over the wide table and one over the bill."""
        return quality.Totals(self.unnamed_wide, self.base)

    def key_check(self) -> DataFrame:
        return quality.key_check(self.base)

    def dict_line_item_type(self) -> DataFrame:
        return profile.dict_line_item_type(self.bill)

    def dict_usage_type(self) -> DataFrame:
        return profile.dict_usage_type(self.bill)

    # analyses
    def analysis(self, name: str, **options) -> DataFrame:
        """D1-D10 by name; ``tag`` picks another tag column for D3-D5."""
        if name == "parent_service_rollup":
            return analyses.parent_service_rollup(self.wide)
        if name == "commitment_utilisation":
            if self._given:
                return analyses.commitment_utilisation(self.unnamed_wide, self.ri_unused)
            return analyses.commitment_utilisation(wide_costs(self.base, **self._wide_options, with_names=False, with_arn=True))
        return getattr(analyses, name)(self.unnamed_wide, **options)
