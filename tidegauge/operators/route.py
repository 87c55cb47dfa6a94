"""Route JSON records by one field, and pick single routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.functions.text import as_column

# The routing field, its named routes and the two catch-all routes.
ROUTE_FIELD = "idc"
NAMED_ROUTES = ("al", "gz")
OTHER_ROUTE = "other"
ERROR_ROUTE = "json_error"


def json_route(record: Column) -> Column:
    """Exactly one route per parsed record.

    Extraction as a variant tells a missing field (NULL) from a JSON ``null`` (a value).
    Malformed text, values that are no object and objects without the field all give NULL.
    """
    path = f"$.{ROUTE_FIELD}"
    missing = F.try_variant_get(record, path, "variant").isNull()
    target = F.try_variant_get(record, path, "string")
    route = F.when(missing, ERROR_ROUTE)
    for name in NAMED_ROUTES:
        route = route.when(target == name, name)
    return route.otherwise(OTHER_ROUTE)


def with_route(records: DataFrame, value: str = "value") -> DataFrame:
    """Add ``route``; the JSON text is parsed once."""
    parsed = compute_once(records, "_json", F.try_parse_json(as_column(value)))
    return compute_once(parsed, "route", json_route(F.col("_json"))).drop("_json")


def select_route(routed: DataFrame, name: str) -> DataFrame:
    return routed.where(F.col("route") == name)


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
