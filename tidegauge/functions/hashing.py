"""Value-derived partition numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.text import as_column
from tidegauge.functions.timeconv import div


def char_sum(text: Column | str) -> Column:
    """Sum of the UTF-16 code units of a text, over its full length.

    ``split(text, '')`` yields code points. One above U+FFFF counts as its two surrogates;
    those are rare, so they are corrected by a second pass that finds only them.
    """
    text = as_column(text)
    zero = F.lit(0).cast("bigint")
    points = F.aggregate(F.split(text, ""), zero, lambda total, char: total + F.ascii(char))

    def surrogates_less_point(total: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        above = point - F.lit(0x10000)
        high = F.lit(0xD800) + div(above, F.lit(0x400))
        low = F.lit(0xDC00) + F.pmod(above, F.lit(0x400))
        return total + high + low - point

    astral = F.regexp_extract_all(text, F.lit(r"[\x{10000}-\x{10ffff}]"), F.lit(0))
    return points + F.aggregate(astral, zero, surrogates_less_point)


def text_partition(text: Column | str, partitions: int) -> Column:
    """Partition number from the characters of the record text."""
    return F.pmod(char_sum(text), F.lit(partitions).cast("bigint")).cast("int")


def json_text(value: Column | str, name: str) -> Column:
    """Text of one top-level JSON field; NULL if the record or the field is unusable."""
    return F.try_variant_get(F.try_parse_json(as_column(value)), f"$.{name}", "string")


def field_partition(value: Column | str, name: str, partitions: int, spread: Column | str) -> Column:
    """Partition number from the characters of a JSON field of the record.

    Records without the field go round-robin by ``spread`` (an offset or id): like a random
    choice this keeps them even, also when a third of them are equal, but a retry gives the
    same answer.
    """
    by_field = text_partition(json_text(value, name), partitions)
    round_robin = F.pmod(as_column(spread), F.lit(partitions)).cast("int")
    return F.coalesce(by_field, round_robin)
