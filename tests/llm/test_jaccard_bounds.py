"""Bounds on shared tokens over ranges of set sizes."""

from pyspark.sql import functions as F

from tidegauge.llm import jaccard_groups


def test_bound_holds_for_all_sizes_of_a_range(spark):
    sizes = [(low, high) for low in range(1, 140) for high in range(low, low * 4 // 3 + 1)]
    rows = spark.createDataFrame(sizes, "low BIGINT, high BIGINT").select("low", "high", jaccard_groups.least_shared(F.col("low"), F.col("high"), 75).alias("least"))
    least = {(r["low"], r["high"]): r["least"] for r in rows.collect()}
    inside = {}
    for low, high in sorted(sizes, key=lambda s: s[1] - s[0]):
        narrower = [inside[r] for r in ((low + 1, high), (low, high - 1)) if r in inside]
        inside[low, high] = min([jaccard_groups.needed(low, high, 75), *narrower])
    assert all(1 <= least[r] <= inside[r] for r in sizes)
    assert max(inside[r] - least[r] for r in sizes) <= 1


def test_a_larger_set_in_the_group_drops_no_link(spark):
    sizes = spark.createDataFrame([(1, 100, 100), (2, 103, 104)], "gid BIGINT, low BIGINT, high BIGINT")
    pairs = spark.createDataFrame([(1, 2, 10)], "a BIGINT, b BIGINT, n BIGINT")
    assert jaccard_groups.needed(100, 103, 75) == 10
    assert [tuple(r) for r in jaccard_groups.qualifying(pairs, sizes, 75).collect()] == [(1, 2)]
    met = spark.createDataFrame([(k, 1, g, g, low, high) for k in range(10) for g, low, high in [(1, 100, 100), (2, 103, 104)]], "list BIGINT, n BIGINT, gid BIGINT, label BIGINT, low BIGINT, high BIGINT")
    assert {r["gid"] for r in jaccard_groups.reaching_groups(met, 75).collect()} == {1, 2}
    assert [tuple(r) for r in jaccard_groups.pairs_across(met, 75).collect()] == [(1, 2)]
