"""Counters that a run's own passes fill: no second read of the rows, and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Watches tables on their way; values are there when an action has gone through them."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """df, counted: its rows, and those for which each of counts, a condition, holds."""
        if name in self._watched:
            raise ValueError(f"{name!r} is watched already")
        self._watched[name] = Observation(name)
        return df.observe(self._watched[name], F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(k) for k, c in counts.items()))

    def values(self) -> dict[str, int]:
        """`name.rows` and `name.condition` of all that was watched; waits for the actions."""
        return {f"{name}.{k}": v for name, seen in self._watched.items() for k, v in seen.get.items()}
