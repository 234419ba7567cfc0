"""User steps: any DataFrame -> DataFrame functions in a row, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df
