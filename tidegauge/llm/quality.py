"""Quality rules: plain counts, and robust multivariate outliers for each language and source.

Every document gives a vector of transformed statistics. For each language and source the
minimum-covariance-determinant estimate is found by concentration steps: the three quarters of
the documents that are nearest to the present centre give the next centre and covariance, until
the determinant no longer falls. Of several starts, one from medians and quartiles, each group
keeps the one that ends with the smallest determinant. A document is rejected if its Mahalanobis distance from the last estimate is beyond the bound.

All is done by SQL functions. The statistics are whole numbers (1/256 of a unit), so their sums
are exact and the result doesn't depend on the order of rows. A step needs one pass: moments
are summed by group and ring of distance, and the nearest rings are added up, the last one by the
part that is wanted of it. No task holds a group. Small groups lean on the estimate of all documents,
weighted like PRIOR documents; it is formed first, from estimates of the groups on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import stored

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
UNIT = 256
SHARE = 0.75
# A step counts if the logarithm of the determinant falls by more than this.
LEAST_FALL = 1e-6
PRIOR = 50
SALTS = 32
# Variance of the nearest three quarters of four normal variables is smaller by this factor.
CONSISTENCY = 1.485
# Least standard deviation of each statistic, in units of the transformed value.
LEAST_SPREAD = {"word_length": 0.05, "symbols": 0.3, "dup_lines": 0.4, "repeats": 0.5}
# The chi-square quantile of four degrees of freedom that one normal document in a million exceeds.
BOUND = 33.4
# The upper quartile of a normal variable, in standard deviations.
QUARTILE = 0.6745
NAMES = list(LEAST_SPREAD)
POSITION = (1 << 31) - 1


def _repeat_words(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in 3-word windows that occur twice or more.

    Windows are sorted by the upper half of their hash with their place in the lower half, as
    plain longs; neighbours that agree are then told apart by the whole hash.
    """
    words = F.col("words")
    window = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    rows = compute_once(rows, "hashes", F.when(F.size(words) >= 3, window).otherwise(F.array().cast("array<bigint>")))
    packed = F.transform("hashes", lambda h, i: h.bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("bigint")))
    rows = compute_once(rows, "packed", F.sort_array(packed))

    def like_neighbour(column, key):
        return lambda x, i: F.coalesce(key(F.get(F.col(column), i - 1)) == key(x), F.lit(False)) | F.coalesce(key(F.get(F.col(column), i + 1)) == key(x), F.lit(False))

    near = F.filter("packed", like_neighbour("packed", lambda x: F.shiftright(x, 31)))
    exact = F.transform(near, lambda x: F.struct(F.get(F.col("hashes"), x.bitwiseAND(F.lit(POSITION)).cast("int")).alias("h"), x.bitwiseAND(F.lit(POSITION)).alias("at")))
    rows = compute_once(rows, "alike", F.sort_array(exact))
    places = F.sort_array(F.transform(F.filter("alike", like_neighbour("alike", lambda x: x["h"])), lambda x: x["at"]))
    zero = F.lit(0).cast("bigint")
    covered = F.aggregate(
        places, F.struct(zero.alias("end"), zero.alias("n")),
        lambda s, at: F.struct((at + 3).alias("end"), (s["n"] + at + 3 - F.greatest(at, s["end"])).alias("n")), lambda s: s["n"],
    )
    return compute_once(rows, "n_repeat_words", covered).drop("hashes", "packed", "alike")


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of each row: ``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed``. Null texts have no words; a missing language or source is one more value."""
    def column(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in docs.columns else F.lit("")

    rows = docs.select(
        F.col("doc_id").cast("bigint"), column("lang").alias("lang"), column("source").alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = compute_once(rows, "words", F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    rows = compute_once(rows, "lines", lines)
    rows = _repeat_words(rows)
    return rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("bigint").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def vectors(stats: DataFrame) -> DataFrame:
    """Add the group and the statistics as whole numbers."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    values = {
        "word_length": F.log(F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(1.0)),
        "symbols": F.log1p(100 * share("n_symbols", "word_chars")),
        "dup_lines": F.log1p(10 * share("n_dup_lines", "n_lines")),
        "repeats": F.log1p(10 * share("n_repeat_words", "n_words")),
    }
    rows = stats.withColumns({name: F.round(UNIT * value).cast("bigint") for name, value in values.items()})
    return rows.withColumn("group", F.concat_ws("\t", "lang", "source"))


PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
MOMENTS = ["n", *(f"s{i}" for i in range(len(NAMES))), *(f"s{i}{j}" for i, j in PAIRS)]

ESTIMATE = [*(f"m{i}" for i in range(len(NAMES))), *(f"l{i}{j}" for i in range(len(NAMES)) for j in range(i + 1))]


def _moments() -> list[Column]:
    x = [F.col(name) for name in NAMES]
    return [F.count("*").alias("n"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(x)), *(F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i, j in PAIRS)]


def _added(moments: DataFrame, *keys: str) -> DataFrame:
    return moments.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in MOMENTS))


def estimates(moments: DataFrame, overall: dict | None = None, weight: int = PRIOR) -> DataFrame:
    """Centre ``m0..`` and Cholesky factor ``l00, l10, ..`` of each group's covariance.

    ``overall`` are the moments that groups lean on, those of all groups if not given.
    """
    d = len(NAMES)
    if overall is None:
        overall = _added(moments).first().asDict()
    total = float(overall["n"] or 0)
    prior = weight if total else 0
    n = F.col("n") + prior
    prior_1 = [prior * overall[f"s{i}"] / total if total else 0.0 for i in range(d)]
    prior_2 = {(i, j): prior * overall[f"s{i}{j}"] / total if total else 0.0 for i, j in PAIRS}
    keys = [c for c in ("start", "group") if c in moments.columns]
    # One select, whose columns build on those before them.
    columns = [*keys, *MOMENTS]
    columns += [((F.col(f"s{i}") + F.lit(float(prior_1[i]))) / n / UNIT).alias(f"m{i}") for i in range(d)]
    columns += [((F.col(f"s{i}{j}") + F.lit(float(prior_2[i, j]))) / n / UNIT**2).alias(f"q{i}{j}") for i, j in PAIRS]
    for i in range(d):
        for j in range(i + 1):
            value = CONSISTENCY * (F.col(f"q{j}{i}") - F.col(f"m{i}") * F.col(f"m{j}"))
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + LEAST_SPREAD[NAMES[i]] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # The added spread keeps the matrix positive; the floor is for rounding alone.
            columns.append((F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l{j}{j}")).alias(f"l{i}{j}"))
    log_det = sum((F.log(f"l{i}{i}") for i in range(1, d)), F.log("l00"))
    return moments.select(*columns, (2 * log_det).alias("log_det")).select(*keys, *MOMENTS, *ESTIMATE, "log_det")


def quartile_start(rows: DataFrame) -> DataFrame:
    """Medians as the centre, and the lesser distance from there to a quartile as the spread.

    What lies on one side, up to half of a group, moves neither far.
    """
    d = len(NAMES)
    parts = rows.groupBy("group").agg(*(F.percentile_approx(name, [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i, name in enumerate(NAMES)))
    centre = [(F.col(f"p{i}")[1] / UNIT).alias(f"m{i}") for i in range(d)]

    def spread(i):
        p = F.col(f"p{i}")
        return F.greatest(F.least(p[2] - p[1], p[1] - p[0]) / UNIT / QUARTILE, F.lit(LEAST_SPREAD[NAMES[i]]))

    factor = [(spread(i) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(d) for j in range(i + 1)]
    return parts.select("group", *centre, *factor)


def distances(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Add ``distance``, the squared Mahalanobis distance from the group's estimate; a row comes once for each ``start``."""
    d = len(NAMES)
    keys = [c for c in ("start",) if c in fitted.columns]
    fitted = fitted.select(*keys, "group", *ESTIMATE)
    # A group may hold a third of all rows: they are spread over SALTS copies of its estimate.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", *NAMES), F.lit(SALTS)).cast("int"))
    out, columns = salted.join(fitted.select("*", salts), ["group", "salt"], "left"), []
    for i in range(d):
        value = F.col(NAMES[i]) / UNIT - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"y{k}")
        columns.append((value / F.col(f"l{i}{i}")).alias(f"y{i}"))
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, d)), F.col("y0") * F.col("y0"))
    return out.select(*keys, *rows.columns, *columns, total.alias("distance")).select(*keys, *rows.columns, "distance")


def nearest(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Moments of the nearest SHARE of each start and group: whole rings of distance, and a part of the last."""
    ring = F.floor(16 * F.log2(1 + F.col("distance"))).cast("int").alias("ring")
    rings = distances(rows, fitted).where("start IS NOT NULL").groupBy("start", "group", ring).agg(*_moments())
    whole = Window.partitionBy("start", "group")
    inner = whole.orderBy("ring").rowsBetween(Window.unboundedPreceding, -1)
    counted = rings.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).withColumn("wanted", F.ceil(SHARE * F.sum("n").over(whole)) - F.col("inside"))
    part = F.least(F.lit(1.0), F.col("wanted") / F.col("n"))
    taken = counted.where("wanted > 0").select("start", "group", *(F.round(part * F.col(m)).cast("bigint").alias(m) for m in MOMENTS))
    return _added(taken, "start", "group")


def concentrated(rows: DataFrame, starts: list[DataFrame], overall: dict | None, weight: int) -> DataFrame:
    """The estimate of the smallest determinant for each group, with its moments.

    Each start and group takes steps until its determinant no longer falls, so there is an end.
    """
    fitted = starts[0].select(F.lit(0).alias("start"), "group", *ESTIMATE)
    for k, more in enumerate(starts[1:], 1):
        fitted = fitted.unionByName(more.select(F.lit(k).alias("start"), "group", *ESTIMATE))
    fitted, state = stored(fitted, "starts"), None
    names = [*MOMENTS, *ESTIMATE, "log_det"]
    while True:
        step = estimates(nearest(rows, fitted), overall, weight)
        if state is None:
            step = step.withColumn("moved", F.lit(True))
        else:
            new = step.select("start", "group", F.struct(*names).alias("new"))
            falls = F.coalesce(F.col("new.log_det") < F.col("log_det") - LEAST_FALL, F.lit(False))
            step = state.join(new, ["start", "group"], "left").select(
                "start", "group", *(F.when(falls, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in names), falls.alias("moved")
            )
        state = stored(step, "step")
        fitted = state.where("moved")
        if fitted.isEmpty():
            break
    best = state.groupBy("group").agg(F.min(F.struct("log_det", "start", *MOMENTS, *ESTIMATE)).alias("best"))
    return best.select("group", *(F.col(f"best.{c}").alias(c) for c in (*MOMENTS, *ESTIMATE, "log_det")))


def fit(rows: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimate of each group of ``rows``."""
    alone = {m: 0 for m in MOMENTS}
    quartiles = stored(quartile_start(rows), "quartiles")
    own = stored(concentrated(rows, [estimates(rows.groupBy("group").agg(*_moments())), quartiles], alone, 0), "own")
    overall = _added(own).first().asDict()
    return stored(concentrated(rows, [own, quartiles], overall, PRIOR), "estimates")


def judged(docs: DataFrame) -> DataFrame:
    """The counts of ``statistics`` with ``base_failed``, ``distance`` and ``kept`` for every row.

    Rows that fail the base rules don't take part in the estimates; they have no distance of their own
    and are not kept. Equal rows count each; an empty table gives no rows.
    """
    rows = stored(vectors(statistics(docs)), "statistics")
    used = rows.where("NOT base_failed")
    fitted = fit(used)
    out = distances(rows, fitted).withColumn("distance", F.when(~F.col("base_failed"), F.col("distance")))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= BOUND, F.lit(False))).drop("group", *NAMES)
