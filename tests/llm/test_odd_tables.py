"""Near duplicates against SQL on odd tables, and masked texts beside columns of clashing names."""

import random

import duckdb

from oracle_check import differences
from tidegauge.llm import jaccard_groups, pii

rnd = random.Random(3)


def words(n):
    return [rnd.choice("abcdefghijklmnopqrstuvwxyz") + str(rnd.randrange(40)) for _ in range(n)]


def test_near_duplicates_equal_sql(spark):
    base = words(60)
    chain = [base[i:] + words(i) for i in range(0, 40, 4)]
    texts = [" ".join(w) for w in chain] + [" ".join(chain[0]).upper()] * 3 + [None, "", " \n\t", "one two", "ONE\ttwo", "one two three", "x " * 3000, "x x x x x", "é É　z"]
    rows = [(i * 7 % 50, text) for i, text in enumerate(texts)] + [(7, "one two"), (7, None), (None, "one two"), (None, " ".join(base))]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    found = jaccard_groups.near_duplicates(table)
    assert differences(found, con, jaccard_groups.ORACLE) == ""


def test_masked_beside_clashing_names(spark):
    names = ["_digits", "_parts", "_around", "_edges", "_text", "_row", "n_chars", "lang"]
    schema = "doc_id BIGINT, text STRING, " + ", ".join(f"{n} INT" for n in names)
    table = spark.createDataFrame([(1, "mail me@home.org now", *[5] * 8), (2, None, *[None] * 8), (3, "plain", *[7] * 8), (3, "plain", *[7] * 8)], schema)
    got = pii.redact(table)
    assert got.dtypes == table.dtypes
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    kept = [n != "n_chars" for n in names]
    assert rows[0][:2] == (1, "mail [EMAIL] now") and rows[0][8] == 16
    assert rows[1] == (2, *[None] * 9)
    assert rows[2] == rows[3] == (3, "plain", *[7 if k else 5 for k in kept])
    assert pii.redact(table.limit(0)).count() == 0
