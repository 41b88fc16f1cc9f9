"""The bill with every facet's view joined back to it on the line key: what the
single-pass wide table avoids. Used as a bench baseline and as a test."""

from __future__ import annotations

from pyspark.sql import DataFrame

from billmodel import CostModel
from billmodel.operators.facets import FACETS


def join_every_facet(model: CostModel) -> DataFrame:
    """Base rows with the columns of each facet as ``<facet>__<column>``."""
    out = model.base
    for name in FACETS:
        view = model.facet(name)
        out = out.join(view.toDF("bb_id", *[f"{name}__{c}" for c in view.columns[1:]]), "bb_id", "left")
    return out
