"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join of facts to a dimension (symbol -> sector style).

    No hint is given: the dimension is broadcast when its measured size in
    bytes is below ``spark.sql.autoBroadcastJoinThreshold`` (checked again at
    run time by AQE), and joined by shuffle beyond it.
    """
    return facts.join(dim, on, how)
