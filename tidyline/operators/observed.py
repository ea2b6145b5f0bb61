"""Counts taken in the pass that writes.

``observe`` adds aggregates to the plan that is written, so the counts need no
second job over the data.  They sit directly below the write: its tasks count
once each, also when a task or an earlier stage is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidyline.functions import profiles as P


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def stage_metrics(stage: str = "stage") -> dict[str, Column]:
    """rows of each stage of the cascade."""
    return {s: count_where(F.col(stage) == s) for s in P.STAGES}


def prediction_metrics(flag: str = "is_noise") -> dict[str, Column]:
    """total, noise, normal."""
    noise = F.col(flag).eqNullSafe(1)
    return {"total": F.count(F.lit(1)), "noise": count_where(noise), "normal": count_where(~noise)}


def change_metrics(changed: str = "is_changed") -> dict[str, Column]:
    """Changed rows."""
    return {"changed": count_where(F.col(changed) == 1)}


def observe_into(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with the metrics as the last step of its plan, for a write of the caller's own."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def write_counted(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict[str, int]:
    """Write ``df`` as Parquet and return the metrics of that one pass."""
    counted, seen = observe_into(df, metrics)
    counted.write.mode("overwrite").parquet(path)
    return seen.get
