"""Phrase mining, license scan and prefix trie against brute force and SQL, odd tables included."""

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle_check import SPARK_TYPES, differences
from tidegauge.llm import license_scan, phrase_index, phrase_mining, prefix_trie, queries

SPARK_TYPES.setdefault("double", "DOUBLE")


def against(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, pa.Table.from_pandas(rows.toPandas(), preserve_index=False) if rows.count() else rows.toArrow())
    return differences(df, con, sql)


# -- phrases ------------------------------------------------------------------------------

ENDS = set(".,;:!?\n\x0b\x0c\r")


def pieces(text):
    piece = [[]]
    for c in text.translate({c: c + 32 for c in range(65, 91)}):
        if c in ENDS:
            piece.append([])
        else:
            piece[-1].append(c)
    return [[w for w in "".join(p).replace("\t", " ").split(" ") if w] for p in piece]


def mined(rows, least, longest, top):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for words in pieces(text or ""):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        held = Counter()
        for p, a in frequent.items():
            for size in range(1, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i : i + size]] = max(held[p[i : i + size]], a)
        best = []
        for p, a in frequent.items():
            if held[p] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mine(spark, rows, **how):
    table = spark.createDataFrame([(i, t, lang, 1, "x", 2) for i, (lang, t) in enumerate(rows)], "doc_id BIGINT, text STRING, lang STRING, n INT, word STRING, pos INT")
    return sorted(map(tuple, phrase_mining.collocations(table, **how).collect()))


def test_phrases_equal_brute_force(spark):
    rnd = random.Random(3)
    words = ["a", "B", "b", "été", "x1", "日本", "long-" + "y" * 40]
    rows = [(rnd.choice(["en", "fr", None, "und"]), "".join(rnd.choice(words) + rnd.choice([" "] * 6 + ["\t", ". ", "\n", " ,"]) for _ in range(rnd.randrange(60)))) for _ in range(80)]
    rows += [("en", None), (None, ""), ("fr", " \n.. "), ("en", "one two three four five six " * 4000)] + [("en", "same text here")] * 5
    assert mine(spark, rows, least=3, top=40) == mined(rows, 3, 5, 40)
    assert mine(spark, rows, least=2, longest=3, top=7) == mined(rows, 2, 3, 7)


def test_no_phrases(spark):
    assert mine(spark, []) == []
    assert mine(spark, [("en", None), (None, "a b")]) == []


def exchanged_bytes(rows):
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)) if t == "binary" else F.lit(8) for c, t in rows.dtypes)
    return rows.agg(F.sum(size)).first()[0]


def test_counts_of_rare_phrases_are_small(spark):
    rnd = random.Random(11)
    rows = [("en", " ".join(f"w{rnd.randrange(1000)}" for _ in range(1000))) for _ in range(200)]
    docs = spark.createDataFrame(rows, "lang STRING, text STRING").coalesce(1)
    relation = phrase_mining.word_relation(docs, b"\xff" * (1 << 17))
    pairs = len({p for _, text in rows for p in zip(text.split(), text.split()[1:])})
    assert exchanged_bytes(phrase_mining.longer_counts(relation)) < 8 * pairs
    assert exchanged_bytes(phrase_mining.slot_counts(relation)) < 4 * pairs


def test_slots_shared_by_phrases(spark, monkeypatch):
    # With 2**20 slots many rare phrases share one that is frequent.
    monkeypatch.setattr(phrase_mining, "HALF", 44)
    rnd = random.Random(13)
    rows = [("en", " ".join(f"w{rnd.randrange(500)}" for _ in range(1000))) for _ in range(60)]
    whole = mined(rows, 3, 5, 400)
    assert len(whole) == 400 and mine(spark, rows, least=3, top=400) == whole


def test_partial_counts_add_up(spark):
    rnd = np.random.default_rng(5)
    ids = rnd.integers(-(2**63), 2**63, 3000)
    drawn = [np.append(rnd.choice(ids, 20_000), [-(2**63), -1, 0, 2**63 - 1]) for _ in range(6)]

    def count(batches):
        counts = phrase_mining.Counts(5)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from counts.add(drawn[i], i // 2)
        yield from counts.rest()

    partial = spark.range(0, 6, 1, 2).mapInArrow(count, phrase_mining.COUNTED)
    total, first = Counter(), {}
    for i, some in enumerate(drawn):
        for x in some.tolist():
            total[x] += 1
            first.setdefault(x, i // 2)
    got = {(r["id"], r["a"], r["part"]) for r in phrase_mining.added_up(partial, 40).collect()}
    assert got == {(x, a, first[x]) for x, a in total.items() if a >= 40}


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 10**13, 4 * 10**15, 3 * 10**13, 10**13 + 7
    row = spark.createDataFrame([(a, n, [left, a], [right, a])], "a BIGINT, n BIGINT, heads ARRAY<BIGINT>, tails ARRAY<BIGINT>")
    cut = row.select(phrase_mining.lowest_cut(2).alias("c")).first()["c"]
    assert tuple(cut) == (1000 * a * n // (left * right), 1, left, right)


# -- licenses -----------------------------------------------------------------------------


def scanned(spark, texts):
    return spark.createDataFrame([(i, t, 1, "t", 0) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, row INT, template STRING, pos INT")


@pytest.fixture(scope="module")
def license_texts():
    rnd = random.Random(8)
    filler = ["the", "license", "mit", "cc", "by", "gnu", "general", "public", "apache", "Ébène", "copy", "日本"]
    mit = dict(license_scan.TEMPLATES)["mit-text"]
    words = mit.split()
    changed = " ".join(words[:20] + ["very", "very"] + words[20:60] + words[62:])
    texts = [None, "", " - ", "CC-BY", "ccKby", "MIT license. mit License", "GNU  general\npublic-license", mit, changed, mit[: len(mit) // 3], mit + "\n" + mit.upper(), "x " * 20000 + mit]
    texts += [t for _, t in license_scan.TEMPLATES] + [mit] * 3
    return texts + [" ".join(rnd.choice(filler) for _ in range(rnd.randrange(80))) for _ in range(60)]


def test_licenses_equal_sql(spark, license_texts):
    table = scanned(spark, license_texts)
    assert against(license_scan.summary(license_scan.scan(table)), license_scan.ORACLE, documents=table) == ""


def test_changed_copies_are_found_and_prose_is_left_alone(spark, license_texts):
    got = {r["doc_id"]: r for r in license_scan.scan(scanned(spark, license_texts)).collect()}
    whole, changed, part, twice, late = got[7], got[8], got[9], got[10], got[11]
    assert [s["template"] for s in whole["spans"]] == ["mit-text"] and whole["spans"][0]["share"] == 1.0
    assert [s["template"] for s in changed["spans"]] == ["mit-text"] and 0.7 < changed["spans"][0]["share"] < 1.0
    assert part["spans"] == [] and len(twice["spans"]) == 2
    assert late["spans"][0]["start"] == 20000 and late["spans"][0]["end"] == late["n_words"]
    assert all(not r["spans"] for i, r in got.items() if i >= 15 + len(license_scan.TEMPLATES))


def test_no_licenses(spark):
    assert license_scan.summary(license_scan.scan(scanned(spark, []))).collect() == []


# -- trie ---------------------------------------------------------------------------------

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, depth INT, conv BIGINT"


def test_trie_equals_sql(spark):
    rnd = random.Random(21)
    rows = []
    for conv in [*range(60), *range(100, 160), *range(250, 290), 7000]:
        turns = ["ab"[rnd.random() < 0.2] for _ in range(rnd.choice([1, 2, 3, 5, 8, 17, 33]))]
        rows += [(conv, None if i == 0 else i, rnd.choice(["user", "user", None]), "é" if t == "a" else t * 3, 1, 2) for i, t in enumerate(turns)]
    rows += [(300, 1, "user", None, 1, 2), (301, 1, "", "", 1, 2), (302, 1, "user", "", 1, 2), (400, 5, "u", "x" * 50000, 0, 0), (400, 5, "u", "x" * 50000, 0, 0)]
    rows += [(500, i, "user", "same", 0, 0) for i in range(150)] + [(conv, i, "user", "same", 0, 0) for conv in range(501, 540) for i in range(conv - 495)]
    table = spark.createDataFrame(rows, TURNS)
    got = prefix_trie.trie(table.unionByName(spark.createDataFrame([(None, 1, "user", "no id", 0, 0)], TURNS)))
    assert against(got, prefix_trie.ORACLE, conversations=table) == ""


def test_long_conversations_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(c, i, "user", "same" if i < 11 + c else f"{c}", 0, 0) for c in range(12) for i in range(11 + 3 * c)]
    table = spark.createDataFrame(rows, TURNS)
    assert against(prefix_trie.trie(table), prefix_trie.ORACLE, conversations=table) == ""


def test_no_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []


def test_two_fattest_numbers(spark):
    rows = spark.range(1, 200).select(F.col("id").alias("high")).withColumn("low", F.explode(F.sequence(F.lit(0), F.col("high") - 1)))
    for row in rows.select("low", "high", prefix_trie.fattest("low", "high").alias("f")).collect():
        assert row["f"] == max(range(row["low"] + 1, row["high"] + 1), key=lambda x: x & -x)


# -- decontamination ----------------------------------------------------------------------


def test_decontamination_equals_sql(spark, docs):
    item = "One two three four five six seven eight nine ten eleven twelve"
    texts = [None, "", item.upper(), "x " + item + " y " + item, "one two", "short item here", item[: item.index(" eleven")] + " é", "a b"] * 2
    items = spark.createDataFrame([(1, item), (10, "Short, item"), (2, None), (3, "b"), (3, "b"), (None, "one")], "item_id BIGINT, text STRING")
    table = docs(texts)
    found = queries.contaminated(phrase_index.contamination(table, items))
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    con.register("benchmark", items.toArrow())
    assert not differences(found, con, phrase_index.ORACLE)
