"""billmodel: a cloud cost-and-usage bill turned into one wide, semantically
named cost table, with reports, reconciliation checks and analyses, as Spark
DataFrame transformations."""

from .model import CostModel
from .operators.base import base_costs
from .operators.wide import wide_costs
from .plans.views import publish_views
from .sources.cur import conform, finalised, read_cur
from .sources.sink import read_wide_table, write_wide_table

__all__ = ["CostModel", "base_costs", "wide_costs", "conform", "finalised", "read_cur",
           "publish_views", "read_wide_table", "write_wide_table"]
