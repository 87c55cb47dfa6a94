"""Secrets: named patterns, and the entropy of a window that slides over candidate strings.

All is done by SQL functions. A candidate is a run of at least WINDOW characters of the base64
and URL alphabets. A window slides over it; the counts of the entering and the leaving character
change by one each, and with them the sum that the Shannon entropy is made of. The largest
entropy of a window is held against the bound of the candidate's character class. Candidates on
the allow list are suppressed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import texts_of
from tidegauge.llm.spans import span_text, with_spans

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}+"

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "entropy"]

# The alphabets of the character classes and the least entropy of a window, in bits.
HEX_CLASS = "0123456789abcdefABCDEF"
ALNUM_CLASS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64_CLASS = ALNUM_CLASS + "+/_=-"
LEAST_BITS = {HEX_CLASS: 3.0, ALNUM_CLASS: 3.6, BASE64_CLASS: 3.8}

# Strings that look random and are none.
ALLOWED = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|your[_-]?(?:api[_-]?)?key|x{6,}",
    r"(?i)abcdefghij|0123456789|1234567890",
    r"^[A-Za-z_=-]+$",
    r"^[0-9+/_=-]+$",
]


def _weight(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))


def largest_entropy(text: Column, alphabet: str) -> Column:
    """The largest Shannon entropy, in bits, of WINDOW neighbouring characters of ``text``.

    With counts c of a window of size w the entropy is log2 w - (sum of c log2 c) / w. The sum
    changes by two terms for a character that enters and two for one that leaves.
    """
    code = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c))
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).cast("double").alias("sum"),
        F.lit(0.0).cast("double").alias("best"), F.array().cast("array<int>").alias("held"), F.lit(0).alias("seen"),
    )

    def slide(s, c):
        full = s["seen"] >= WINDOW
        gone = F.when(full, F.get(s["held"], s["seen"] % WINDOW)).otherwise(F.lit(-1))
        n_in = F.get(s["counts"], c)
        entered = s["sum"] + _weight(n_in + 1) - _weight(n_in)
        n_out = F.get(s["counts"], gone) + F.when(gone == c, 1).otherwise(0)
        total = F.when(full, entered + _weight(n_out - 1) - _weight(n_out)).otherwise(entered)
        bits = F.when(s["seen"] >= WINDOW - 1, math.log2(WINDOW) - total / WINDOW).otherwise(F.lit(0.0))
        counts = F.transform(s["counts"], lambda n, i: n + F.when(i == c, 1).otherwise(0) - F.when(i == gone, 1).otherwise(0))
        held = F.when(full, F.transform(s["held"], lambda h, i: F.when(i == s["seen"] % WINDOW, c).otherwise(h))).otherwise(F.concat(s["held"], F.array(c)))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(s["best"], bits).alias("best"), held.alias("held"), (s["seen"] + 1).alias("seen"))

    return F.aggregate(code, start, slide, lambda s: s["best"])


def allowed(match: Column) -> Column:
    verdict = F.lit(False)
    for pattern in ALLOWED:
        verdict = verdict | match.rlike(pattern)
    return verdict


def _entropy(match: Column, before: Column) -> Column:
    def high(alphabet):
        return largest_entropy(match, alphabet) >= LEAST_BITS[alphabet]

    bits = F.when(match.rlike("^[0-9a-fA-F]+$"), high(HEX_CLASS)).when(match.rlike("^[0-9A-Za-z]+$"), high(ALNUM_CLASS)).otherwise(high(BASE64_CLASS))
    return F.when(allowed(match) | match.rlike("^[0-9a-f]+$"), F.lit(False)).otherwise(bits)


def _assign(match: Column, before: Column) -> Column:
    return F.char_length(F.regexp_extract(match, ASSIGN, 1)) >= 12


def _always(match: Column, before: Column) -> Column:
    return F.lit(True)


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, assign, access, hex, entropy)``: the spans of each kind, as in ``pii.find``.

    Null texts count as empty; empty texts have no spans; equal rows and rows without an id stay.
    """
    rows = texts_of(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = compute_once(rows, "_digits", F.col("text").rlike("[0-9]"))
    text = F.col("text")
    assigned = text.rlike("[:=]")
    for kind, pattern, possible, valid in (
        ("assign", ASSIGN, assigned, _assign),
        ("access", ACCESS, text.contains("AKIA"), _always),
        ("hex", HEX, None, _always),
        ("entropy", CANDIDATE, F.col("_digits"), _entropy),
    ):
        rows = with_spans(rows, kind, pattern, possible, valid)
    return rows.select("doc_id", *KINDS)


def summary(found: DataFrame) -> DataFrame:
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(span_text(BASE), 256).alias("base_sha256"), span_text(KINDS).alias("spans"), counts[3])
