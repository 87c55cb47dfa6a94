"""Places of pattern matches in a text, by SQL functions only.

A regular expression is run twice: once for the matches and once for what lies between them. The
position of a match, in code points, is the length of all that stands before it. These sums are
formed in blocks, so a text with very many matches is not copied once for each of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once

BLOCK = 64
SPAN = "struct<start:int,end:int,text:string,around:string>"
# Characters of context on each side, and how many neighbouring matches of LEAST_MATCH they may hold.
CONTEXT = 40
LEAST_MATCH = 11
NEIGHBOURS = -(-CONTEXT // LEAST_MATCH)


def cut(text: Column, pattern: str, possible: Column | None = None) -> Column:
    """``gaps`` and ``found``: what lies between the matches, and the matches, in order.

    ``possible`` is a cheap test that holds for every text with a match.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(gaps.alias("gaps"), found.alias("found"))
    if possible is None:
        return both
    none = F.struct(F.array(text).alias("gaps"), F.array().cast("array<string>").alias("found"))
    return F.when(possible, both).otherwise(none)


def with_context(rows: DataFrame, parts: str, name: str) -> DataFrame:
    """Add column ``name``: CONTEXT characters of the text on both sides of each match of ``cut``.

    They are put together from what lies next to the match, other matches too. A 0 stands for the
    match. Matches have LEAST_MATCH characters or more, so a few of them are enough.
    """
    found, gaps = F.col(f"{parts}.found"), F.col(f"{parts}.gaps")
    edges = F.struct(
        F.transform(gaps, lambda g: F.left(g, F.lit(CONTEXT))).alias("heads"), F.transform(gaps, lambda g: F.right(g, F.lit(CONTEXT))).alias("tails")
    )
    rows = compute_once(rows, "_edges", F.when(F.size(found) > 0, edges))
    heads, tails = F.col("_edges.heads"), F.col("_edges.tails")

    def around(match, i):
        before = [part for k in range(NEIGHBOURS, 0, -1) for part in (F.get(tails, i - k), F.get(found, i - k))]
        after = [part for k in range(1, NEIGHBOURS + 1) for part in (F.get(found, i + k), F.get(heads, i + k + 1))]
        left, right = F.concat_ws("", *before, F.get(tails, i)), F.concat_ws("", F.get(heads, i + 1), *after)
        return F.concat(F.right(left, F.lit(CONTEXT)), F.lit("0"), F.left(right, F.lit(CONTEXT)))

    return compute_once(rows, name, F.transform(found, around)).drop("_edges")


def places(parts: Column, around: Column | None = None) -> Column:
    """``start``, ``end``, ``text`` and the characters ``around`` each match of ``cut``, empty if not given."""
    gaps, found = parts["gaps"], parts["found"]

    def step(match, i):
        gap = F.get(gaps, i)
        return F.struct(F.char_length(gap).alias("gap"), F.char_length(match).alias("size"), match.alias("text"), (F.lit("") if around is None else F.get(around, i)).alias("around"))

    steps = F.transform(found, step)
    n_blocks = F.floor((F.size(found) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n_blocks), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + x["gap"] + x["size"]))
    begins = F.aggregate(
        sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
    )["all"]

    def within(block, begin):
        first = F.struct(begin.alias("at"), F.array().cast(f"array<{SPAN}>").alias("all"))

        def add(s, x):
            start = s["at"] + x["gap"]
            span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["text"].alias("text"), x["around"].alias("around"))
            return F.struct((start + x["size"]).alias("at"), F.concat(s["all"], F.array(span)).alias("all"))

        return F.aggregate(block, first, add)["all"]

    spans = F.flatten(F.zip_with(blocks, begins, within))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def replaced(parts: Column, sign: str, valid: Callable[[Column, Column], Column], around: Column | None = None) -> Column:
    """The text again, with ``sign`` for each valid match."""
    gaps, found = parts["gaps"], parts["found"]

    def put(gap, i):
        match = F.get(found, i)
        shown = F.when(match.isNull(), F.lit("")).when(valid(match, F.lit("") if around is None else F.get(around, i)), F.lit(sign)).otherwise(match)
        return F.concat(gap, shown)

    return F.array_join(F.transform(gaps, put), "")


def with_spans(rows: DataFrame, name: str, pattern: str, possible: Column | None, valid: Callable[[Column, Column], Column], context: bool = False) -> DataFrame:
    """Add column ``name``: the valid matches in ``text`` as an array of spans, held against their context if wanted."""
    rows = compute_once(rows, "_parts", cut(F.col("text"), pattern, possible))
    rows = with_context(rows, "_parts", "_around") if context else rows
    found = F.filter(places(F.col("_parts"), F.col("_around") if context else None), lambda s: valid(s["text"], s["around"]))
    return compute_once(rows, name, found).drop("_parts", "_around")


def span_text(kinds: list[str]) -> Column:
    """``kind:start:end`` of the span columns named, by start and then by the order of kinds."""
    def ranked(rank):
        return F.transform(kinds[rank], lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    names = F.array(*map(F.lit, kinds))
    ordered = F.sort_array(F.concat(*map(ranked, range(len(kinds)))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")
