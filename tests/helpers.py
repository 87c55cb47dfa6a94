"""Small tools shared by the tests."""

import os
import time



SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def column_of(spark, values, expression, kind="string"):
    """Values of one expression over the column ``v``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i INT, v {kind}")
    result = rows.select("i", expression.alias("r")).collect()
    return [row["r"] for row in sorted(result, key=lambda row: row["i"])]


def as_rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def drop_file(folder, name, lines, order):
    """Put a text file into a stream folder; ``order`` fixes its place among the others."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    stamp = time.time() - 1_000 + order
    os.utime(path, (stamp, stamp))


def values(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")
