"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

All is done by SQL functions. The patterns are those of the contract written so that a match is
found without trying each start again: possessive repeats, and a start only where a run of
characters begins or where the match before ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import texts_of
from tidegauge.llm.spans import cut, replaced, span_text, with_context, with_spans

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(][\x20.-]?)(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "ssn", "local_phone"]
KINDS = BASE + ADDED

# A span is kept from this score on.
LEAST_SCORE = 0.6

# Words that make a number more likely to be of a kind, in the tables' languages.
CONTEXT_WORDS = {
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|social-security",
    "local_phone": "phone|tel|telephone|call|mobile|cell|fax|telefon|telefono|teléfono|téléphone",
}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _email(match: Column, around: Column) -> Column:
    return F.lit(True)


def _ip(match: Column, around: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card(match: Column, around: Column) -> Column:
    plain = digits(match)
    return F.char_length(plain).between(14, 19) & F.call_function("luhn_check", plain)


def _phone(match: Column, around: Column) -> Column:
    return F.char_length(digits(match)).between(10, 15)


def mod_97(match: Column) -> Column:
    """The remainder of an account number by ISO 7064: head to the end, letters as 10 to 35."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def value(c):
        return F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)

    return F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0),
        lambda rest, c: ((rest * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97).cast("int"),
    )


def _near(kind: str, around: Column) -> Column:
    return around.rlike(rf"(?i)(?<![a-z])(?:{CONTEXT_WORDS[kind]})(?![a-z])")


def score(kind: str, match: Column, around: Column) -> Column:
    """What pattern, checksum and context words say together of an added kind."""
    if kind == "iban":
        known = F.when(mod_97(match) == 1, 0.6).otherwise(-0.4)
    elif kind == "ssn":
        known = F.when(~match.rlike("^(?:000|666|9..)|-00-|-0000$"), 0.2).otherwise(-0.4)
    else:
        known = F.lit(0.0)
    return 0.3 + known + F.when(_near(kind, around), 0.4).otherwise(0.0)


def _scored(kind: str):
    return lambda match, around: score(kind, match, around) >= LEAST_SCORE


def rules() -> list[tuple[str, str, Column, object]]:
    """``(kind, pattern, cheap test, verdict)`` in the order of kinds."""
    text, digit = F.col("text"), F.col("_digits")
    return [
        ("email", EMAIL, text.contains("@"), _email),
        ("ip", IP, digit, _ip),
        ("card", CARD, digit, _card),
        ("phone", PHONE, digit & text.contains("+"), _phone),
        ("iban", IBAN, digit, _scored("iban")),
        ("ssn", SSN, digit & text.contains("-"), _scored("ssn")),
        ("local_phone", LOCAL_PHONE, digit, _scored("local_phone")),
    ]


def _prepared(docs: DataFrame) -> DataFrame:
    rows = compute_once(docs.withColumn("text", F.coalesce("text", F.lit(""))), "_digits", F.col("text").rlike("[0-9]"))
    return rows


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, email, ip, card, phone, iban, ssn, local_phone)``: the spans of each kind.

    A span has ``start`` and ``end`` in code points (end exclusive), its ``text`` and the
    characters ``around`` it where the kind looks at them. Null texts count as empty, empty texts have no spans; equal rows are
    kept, as is a row without an id.
    """
    rows = _prepared(texts_of(docs))
    for kind, pattern, possible, valid in rules():
        rows = with_spans(rows, kind, pattern, possible, valid, kind in ADDED)
    return rows.select("doc_id", *KINDS)


def summary(found: DataFrame) -> DataFrame:
    """Counts and span lists of ``find``."""
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts[: len(BASE)], F.sha2(span_text(BASE), 256).alias("base_sha256"), span_text(KINDS).alias("spans"), *counts[len(BASE) :]
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with a sign such as ``[EMAIL]`` for each span, kind after kind; null texts stay null.

    All other columns stay as they are but ``n_chars``, where there is one.
    """
    # The caller's columns are numbered meanwhile, so that none of them meets a name used here.
    numbered = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    rows = docs.toDF(*numbered.values()).withColumnRenamed(numbered["text"], "text")
    rows = compute_once(rows, "_digits", F.coalesce(F.col("text").rlike("[0-9]"), F.lit(False)))
    for kind, pattern, possible, valid in rules():
        parts = compute_once(rows, "_parts", cut(F.col("text"), pattern, F.coalesce(possible, F.lit(False))))
        parts = with_context(parts, "_parts", "_around") if kind in ADDED else parts
        clean = replaced(F.col("_parts"), f"[{kind.upper()}]", valid, F.col("_around") if kind in ADDED else None)
        text = F.when(F.size("_parts.found") > 0, clean).otherwise(F.col("text"))
        rows = compute_once(parts, "_text", text).withColumn("text", F.col("_text")).drop("_parts", "_around", "_text")
    made = {"text": F.col("text"), "n_chars": F.char_length("text")}
    return rows.select(*(
        made[name].cast(docs.schema[name].dataType).alias(name) if name in made else F.col(number).alias(name) for name, number in numbered.items()
    ))
