"""The robust estimate with nearly as many outliers as it tolerates."""

import numpy as np

from tidegauge.llm import quality


def test_a_cluster_of_outliers_is_rejected(spark):
    rng = np.random.default_rng(5)
    rows, first = [], 0
    for group, share in (("a", 0.22), ("b", 0.24), ("c", 0.0)):
        values = rng.normal(2.0, 0.7, (1500, 4))
        bad = int(1500 * share)
        values[:bad] += 7 * np.array([1.0, 1.0, 0.0, 1.0])
        rows += [(first + i, group, i < bad, *map(int, np.rint(256 * v))) for i, v in enumerate(values)]
        first += len(values)
    columns = "doc_id BIGINT, group STRING, bad BOOLEAN, " + ", ".join(f"{n} BIGINT" for n in quality.NAMES)
    table = spark.createDataFrame(rows, columns)
    got = quality.distances(table, quality.fit(table)).collect()
    assert len(got) == len(rows)
    assert all(r["distance"] > quality.BOUND for r in got if r["bad"])
    assert sum(r["distance"] > quality.BOUND for r in got if not r["bad"]) <= 2
