"""A facet: a per-service slice of the base bill, declared once.

A facet is a predicate plus an ordered set of named column expressions over
the base bill. It renders two ways:

* ``view(base)``: ``where(predicate).select(bb_id, columns...)``, the debugging
  view of one service (the model's ``dwd`` views);
* ``guarded(name)``: ``CASE WHEN bb_id IS NOT NULL AND predicate THEN column
  END``, used by the wide table. With a unique ``bb_id``, a LEFT JOIN of the
  view back onto the base on ``bb_id`` gives exactly the guarded column (a
  NULL key joins nothing, hence the key test), so the wide table is one
  projection over one scan instead of a chain of self-joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Facet:
    name: str
    predicate: Column | None
    columns: dict[str, Column] = field(default_factory=dict)

    def view(self, base: DataFrame) -> DataFrame:
        rows = base if self.predicate is None else base.where(self.predicate)
        return rows.select(F.col("bb_id"), *[c.alias(n) for n, c in self.columns.items()])

    @cached_property
    def guard(self) -> Column:
        keyed = F.col("bb_id").isNotNull()
        return keyed if self.predicate is None else keyed & self.predicate

    def guarded(self, name: str) -> Column:
        return F.when(self.guard, self.columns[name])
