"""Helpers that add columns to a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and columns read as it stands.

    A plain column is copied into every filter above it when Catalyst pushes the filter down,
    so a parsed line would be parsed again per filter, and generated code can outgrow the
    JVM's method limit. No filter on a generated column moves below its generator, so a
    one-element ``explode`` keeps the value computed once.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))
