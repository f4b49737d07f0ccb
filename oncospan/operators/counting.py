"""Row counts that the jobs of a run take on their way: no table is read again to be counted."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StepCounts:
    """Rows before and after each required column of a builder, as the builder's own job saw them."""

    def __init__(self):
        self._observed: dict[str, tuple[Observation, list[str]]] = {}

    def require(self, df: DataFrame, table: str, columns: list[str]) -> DataFrame:
        """Rows of ``df`` with all ``columns`` not null; counted when the result is first written or read."""
        observed = Observation(f"{table}-{uuid.uuid4().hex[:8]}")
        kept, counts = F.lit(True), [F.count(F.lit(1)).alias("step_0")]
        for step, column in enumerate(columns, 1):
            kept = kept & F.col(column).isNotNull()
            counts.append(F.count_if(kept).alias(f"step_{step}"))
        self._observed[table] = observed, columns
        return df.observe(observed, *counts).dropna(subset=columns)

    def rows(self, table: str) -> list[tuple[str, int, str, int]]:
        """(table, step, column, rows) of a builder whose job has run; none of one that has no required columns."""
        if table not in self._observed:
            return []
        observed, columns = self._observed[table]
        found = observed.get
        return [(table, step, column, found[f"step_{step}"]) for step, column in enumerate(["", *columns])]
