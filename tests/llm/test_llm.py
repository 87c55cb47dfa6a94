"""Operators for training data against brute force, and on empty, null, repeated and odd rows."""

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidegauge.llm import bpe_chunks, graph, jaccard_groups, phrase_index, pii, pseudo_lm, quality, repair_files, secret_scan, sharding, tool_links

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
rnd = random.Random(11)
VOCABULARY = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 6))) for _ in range(300)]


def prose(n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


ODD = [
    None, "", " \n\t ", "  x", "a  b   c　 d ", "é x ́y", "Σ ΑΣ", "a\x1c b \x85 c", "hello<|endoftext|> world <|startoftext|>x",
    "x" * 6000, "don't we'll I'M", "日本語 テキスト 12 345", "“quoted” … ok", "😀 😀\n😀", prose(9000),
] + ["".join(rnd.choice(list("ab c\n\t  '.,1|<é́ß日\x85") + ["<|endoftext|>"]) for _ in range(rnd.randrange(70))) for _ in range(80)]


def of_docs(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def fold(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def test_bpe_equals_the_library(docs):
    table = docs(ODD + ODD[:20])
    texts, tokenizer = of_docs(table), Tokenizer.from_file(WORD)
    got = bpe_chunks.encode_decode(table, WORD).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_chunks_are_reused():
    passage = prose(3000)
    coder = bpe_chunks.ChunkEncoder(WORD)
    coder.encode(pa.array([passage]))
    known = len(coder.chunks)
    coder.encode(pa.array(["other " + passage]))
    assert known > 3 and len(coder.chunks) <= known + 3


def test_token_files_round_trip(docs):
    table = docs(ODD)
    texts, tokenizer = of_docs(table), Tokenizer.from_file(BYTE)
    got = sorted(repair_files.token_files(table, BYTE, 2).collect())
    start = 0
    for row in got:
        ids = [*tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"], np.frombuffer(row["ids"], "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)
    assert [r["doc_id"] for r in got] == sorted(texts)


def test_repair_random_access():
    ids = np.array([rnd.choice([1, 2, 3, 1, 2]) for _ in range(5000)] + [7] * 301)
    rules, sizes, sequence = repair_files.compress(ids, 10)
    assert len(rules) and len(sequence) < len(ids)
    for start, stop in [(0, None), (0, 0), (17, 18), (100, 4321), (5290, 9999)]:
        assert repair_files.expand(rules, sizes, sequence, 10, start, stop).tolist() == ids[start:stop].tolist()


def shingles(text):
    words = SPACED.findall(fold(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def changed(text, part):
    words = text.split(" ")
    for _ in range(int(len(words) * part)):
        words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY)
    return " ".join(words)


def test_near_duplicates_against_all_pairs(docs):
    passage = prose(40)
    bases = [prose(rnd.randrange(3, 120)) for _ in range(25)]
    texts = [None, "", "one two", "ONE two", "one"] + bases
    texts += [changed(rnd.choice(bases), rnd.choice([0, 0.01, 0.03, 0.06])) for _ in range(120)]
    texts += [prose(30) + " " + passage for _ in range(30)]
    table = docs(texts)
    sets = {i: shingles(t) for i, t in of_docs(table).items()}
    best = {i: i for i in sets}
    edges = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(len(texts)):
        for a, b in edges:
            best[a] = best[b] = min(best[a], best[b])
    for parts in (1, 7):
        got = jaccard_groups.near_duplicates(table.repartition(parts)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(s), best[i]) for i, s in sets.items()}


@pytest.mark.parametrize("numbers", [[5], [1, 1, 2, 300], [0, 70_000], [7, 7 + (1 << 40)], [-(1 << 63), -5, 0, (1 << 63) - 1]])
def test_packed_numbers(numbers):
    packed = jaccard_groups.packed(np.array(numbers, dtype=np.int64))
    assert jaccard_groups.unpacked(packed).tolist() == numbers


def test_equal_sets_are_opened_once(spark):
    members = spark.createDataFrame([(1, b"x"), (4, b"x"), (9, b"x"), (4, b"y"), (6, b"y"), (7, b"z")], "gid BIGINT, print BINARY")
    copies = jaccard_groups.equal_sets(members)
    assert sorted(map(tuple, copies.collect())) == [(1, 4), (1, 9), (4, 6)]
    pairs = spark.createDataFrame([(1, 4), (1, 7), (7, 9), (4, 7), (2, 3)], "a BIGINT, b BIGINT")
    assert sorted(map(tuple, jaccard_groups.between_twins(pairs, copies).collect())) == [(1, 7), (2, 3)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 90, 90: 90, 95: 90}


def test_contamination_against_brute_force(spark, docs):
    items = [(1, prose(30)), (2, prose(12)), (3, "Only three words"), (4, None), (5, "--"), (6, "solo"), (7, prose(30)), (1, prose(11))]
    items.append((8, items[0][1]))
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    table = docs([None, "", "Only, THREE words! only three words words", "xx solo", items[1][1], prose(50) + " " + items[0][1] + " " + prose(5), " ".join(items[6][1].split()[3:20]), prose(80)] + [items[0][1]] * 3)
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, text in items:
        words = pattern.findall(fold(text or ""))
        for w in [words] if 0 < len(words) < 10 else [words[k : k + 10] for k in range(len(words) - 9)]:
            windows.setdefault(tuple(w), set()).add(i)
    got = {r["doc_id"]: r for r in phrase_index.contamination(table, benchmark).collect()}
    for i, text in of_docs(table).items():
        words, hit, found = pattern.findall(fold(text)), set(), set()
        for w, owners in windows.items():
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    found |= owners
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(words), len(hit), sorted(found))


def test_proximity(spark, docs):
    pairs = spark.createDataFrame([(1, "Red", "fox"), (2, "red", "hen"), (3, "two words", "x")], "pair_id BIGINT, left STRING, right STRING")
    got = phrase_index.proximity_matches(docs(["red old fox fox", "hen red", "red a b c fox", None]), pairs, 2)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0, 2), (2, 2, 1, 0)]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PII = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]
WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SECRETS = [
    (ASSIGN, lambda m: len(re.fullmatch(ASSIGN, m)[2]) >= 12), (r"AKIA[A-Z0-9]+", lambda m: len(m) >= 18), (r"[0-9a-f]+", lambda m: len(m) >= 16),
]


@pytest.mark.parametrize("module, rules", [(pii, PII), (secret_scan, SECRETS)])
def test_spans_against_regular_expressions(docs, module, rules):
    pieces = list("ab@@..-+ 0123456789 ()é😀\n%'\":=") + ["token", "SECRET", "api_key", "AKIA", "ABCDEF1234", "abcdef012345", "4539148803436467", "10.2.3.4", "+1 (743) 555-3824"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(90))) for _ in range(250)]
    texts += [None, "", "a@b.c_x@y.org a@b@c.d", "1.2.3.4.5.6.7.8 001.02.3.4 256.1.1.1", " ".join(f"u{i}@b.com 10.0.0.{i % 300} +1 555 000 {1000 + i}" for i in range(700))]
    table = docs(texts)
    got = module.summary(module.find(table)).collect()
    assert len(got) == len(texts)
    for row in got:
        text = of_docs_cache(table)[row["doc_id"]]
        spans = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m.group()))
        listed = ",".join(f"{module.BASE[k]}:{s}:{e}" for s, k, e in spans)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert list(row)[1 : 1 + len(rules)] == [sum(k == j for _, k, _ in spans) for j in range(len(rules))]
        assert [s for s in row["spans"].split(",") if s and s.split(":")[0] in module.BASE] == [s for s in listed.split(",") if s]


_CACHE = {}


def of_docs_cache(table):
    if id(table) not in _CACHE:
        _CACHE[id(table)] = of_docs(table)
    return _CACHE[id(table)]


def test_added_personal_data(docs):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01", "ssn 123-45-6789 or 000-45-6789", "call (743) 555-3824", "no (743) 555-3824"]
    rows = sorted(pii.summary(pii.find(docs(texts))).collect())
    assert [r["spans"] for r in rows] == ["iban:5:32", "ssn:4:15", "local_phone:5:19", ""]
    table = docs(texts + ["mail a@b.org", None])
    clean = sorted(pii.redact(table).collect())
    assert clean[4]["text"] == "mail [EMAIL]" and clean[4]["n_chars"] == 12 and clean[5]["text"] is None
    assert pii.redact(table).dtypes == table.dtypes


def entropy(text):
    return max(math.log2(20) - sum(n * math.log2(n) for n in Counter(text[i : i + 20]).values()) / 20 for i in range(len(text) - 19))


def test_window_entropy(spark):
    texts = ["".join(rnd.choice("abcXYZ0189_") for _ in range(n)) for n in (20, 21, 45, 80)]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", secret_scan.largest_entropy(F.col("t"), secret_scan.BASE64_CLASS).alias("e"))
    for row in rows.collect():
        assert abs(row["e"] - entropy(row["t"])) < 1e-9


def test_allow_list(docs):
    texts = ["Zx9Kq2LmPw8RtYv3BnCd4EfGh", "123e4567-e89b-12d3-a456-426614174000", "thereandbackagainwithoutend", "example_Zx9Kq2LmPw8RtYv3B", "aaaaaaaaaaaaaaaaaaaaaaa1"]
    assert [r["n_entropy"] for r in sorted(secret_scan.summary(secret_scan.find(docs(texts))).collect())] == [1, 0, 0, 0, 0]


def test_quality_counts_and_outliers(docs):
    clean = [prose(rnd.randrange(60, 300)) for _ in range(150)]
    junk = [" ".join(w + "###" for w in prose(100).split()) for _ in range(8)]
    texts = [None, "", "a b c", "a a a a a a", "x\nx\n\n \ny\nx", prose(9) * 40] + clean + junk
    table = docs(texts)
    got = {r["doc_id"]: r for r in quality.judged(table).collect()}
    for i, text in of_docs(table).items():
        words = SPACED.findall(text)
        seen = Counter(zip(words, words[1:], words[2:]))
        covered = {j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        row = got[i]
        assert (row["n_words"], row["word_chars"], row["n_symbols"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (row["n_dup_lines"], row["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert all(got[i]["kept"] for i in range(7, 157)) and not any(got[i]["kept"] for i in [*range(1, 7), *range(157, 165)])


def test_mahalanobis_distance(spark):
    rng = np.random.default_rng(3)
    values = np.rint(256 * rng.multivariate_normal([1, 2, 0, 1], np.diag([0.2, 0.4, 0.1, 0.3]) + 0.05, 400)).astype(int)
    rows = spark.createDataFrame([(i, "g", *map(int, v)) for i, v in enumerate(values)], "doc_id BIGINT, group STRING, " + ", ".join(f"{n} BIGINT" for n in quality.NAMES))
    moments = rows.groupBy("group").agg(*quality._moments())
    got = {r["doc_id"]: r["distance"] for r in quality.distances(rows, quality.estimates(moments)).collect()}
    x = values / 256
    centre, second = x.mean(0), x.T @ x / len(x)
    covariance = quality.CONSISTENCY * (second - np.outer(centre, centre)) + np.diag([s**2 for s in quality.LEAST_SPREAD.values()])
    want = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(covariance), x - centre)
    assert np.allclose([got[i] for i in range(len(x))], want)


def test_shards(docs):
    texts = [prose(rnd.randrange(1, 60)) for _ in range(400)] + ["copy of one"] * 300 + [None, "", ""]
    table = docs(texts)
    got = sharding.sharded(table).collect()
    by_id = of_docs(table)
    assert len(got) == len(texts)
    sizes, slots = Counter(), {}
    for row in got:
        raw = by_id[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"], row["tokens"]) == (len(raw) + 1, zlib.crc32(raw), len(raw.split()))
        sizes[row["shard"]] += row["size"]
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_tool_links(spark):
    def message(turn, body, conv=1):
        return (conv, turn, "assistant", body if isinstance(body, str) or body is None else json.dumps(body))

    def call(i, name="search", after=(), **arguments):
        return {"tool_calls": [{"id": i, "name": name, "arguments": arguments, "after": list(after)}]}

    rows = [
        message(0, "plain text"), message(1, None), message(2, "{broken"), message(3, {"other": 1}),
        message(4, call("a", query="x", limit=3)), message(5, {"tool_call_id": "a", "content": {"b": 1, "a": [2, "é"]}}), message(6, {"tool_call_id": "a", "content": 0}),
        message(7, call("w", after=["z"], query=5, extra=True)), message(8, call("z", "measure", ["a"], size=1.5, long=False)), message(9, {"tool_call_id": "zz", "content": "?"}),
        message(10, call("r1", "none", ["r2"])), message(11, call("r2", "measure", ["r1"], size="s")), message(12, {"tool_call_id": "r3", "content": None}), message(13, call("r3", query="q")),
        message(1, call("a", query="other"), conv=2),
    ]
    table = spark.createDataFrame(rows + rows[:5], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = {(r["conv_id"], r["call_id"]): r for r in tool_links.linked(table, tool_links.TOOLS).collect()}
    assert {k: (r["status"], r["problems"]) for k, r in got.items()} == {
        (1, "a"): ("linked", ""), (1, "w"): ("no result", "type query,unexpected extra"), (1, "z"): ("no result", ""), (1, "zz"): ("no call", None),
        (1, "r1"): ("no result", "unknown tool"), (1, "r2"): ("no result", "missing long,type size"), (1, "r3"): ("early result", ""), (2, "a"): ("no result", ""),
    }
    assert got[1, "a"]["canonical"] == '{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search","result":{"a":[2,"é"],"b":1}}'
    order = sorted((r["due_turn"], r["due_pos"], r["hops"], r["turn"], k[1]) for k, r in got.items() if k[0] == 1 and r["hops"] is not None)
    assert [o[-1] for o in order] == ["a", "z", "w", "r3"]


def test_pseudo_likelihood(docs):
    grammar = [" ".join(["the cat sat on the mat", "a dog ran to a park"][rnd.randrange(2)] for _ in range(40)) for _ in range(150)]
    held_out, words = grammar[:10], None
    shuffled = []
    for text in held_out:
        words = text.split()
        rnd.shuffle(words)
        shuffled.append(" ".join(words))
    got = {r["doc_id"]: r for r in pseudo_lm.pseudo_likelihood(docs(grammar[10:] * 12 + held_out + shuffled + [None, ""])).collect()}
    n = 140 * 12
    assert all(got[n + 1 + k]["mean_score"] > got[n + 11 + k]["mean_score"] for k in range(10))
    for i in (n + 21, n + 22):
        assert (got[i]["n_tokens"], got[i]["score"], got[i]["mean_score"]) == (0, 0.0, None)


def test_scores_are_sums_over_contexts():
    model, classes = pseudo_lm.start(np.ones(pseudo_lm.CLASSES)), (np.arange(pseudo_lm.SLOTS) % pseudo_lm.CLASSES).astype(np.int16)
    n, total = pseudo_lm.scores(pa.array([prose(50), "", prose(3)]), classes, model)
    assert n.tolist() == [50, 0, 3] and total[1] == 0
    for big in (0, 50):
        model["bias"][0, 0] += big
        model["branch_bias"][0] += big
        around, target = rng_contexts()
        want = pseudo_lm.forward(model, around)[1][np.arange(len(target)), target]
        assert np.allclose(pseudo_lm.target_logp(model, around, target), want, atol=1e-4)


def test_every_word_is_a_target_once():
    first = np.array([0, 1, 9, 9, 46])
    own = np.zeros(first[-1], dtype=np.int64)
    chosen = np.concatenate([pseudo_lm.targets_of(own, first, turn) for turn in range(pseudo_lm.ROUNDS)])
    assert sorted(chosen.tolist()) == list(range(len(own)))


@pytest.mark.parametrize("known", [1 << 16, 4, 0])
def test_scores_hold_each_words_share(docs, monkeypatch, known):
    """Words of one class score by their own counts, whether these are sent or joined."""
    monkeypatch.setattr(pseudo_lm, "KNOWN", known)
    monkeypatch.setattr(pseudo_lm, "ROUNDS", 0)
    texts = ["a b b c c c c", "a A zz\u00e9", "c", "b b b b q", None] * 2 + ["once"]
    # All words in one group: the class says nothing, the share all.
    monkeypatch.setattr(pseudo_lm, "start", lambda counts: {n: np.zeros(s, dtype=np.float32) for n, s in pseudo_lm.SHAPES.items()})
    words = Counter(w for t in texts for w in (t or "").lower().split())
    monkeypatch.setattr(pseudo_lm, "word_classes", lambda counts: (np.full(pseudo_lm.SLOTS, 200, dtype=np.int16), np.full(pseudo_lm.CLASSES, sum(words.values()))))
    table = docs(texts)
    for row in pseudo_lm.pseudo_likelihood(table).collect():
        own = (of_docs(table)[row["doc_id"]]).lower().split()
        want = sum(math.log(words[w] / sum(words.values())) - math.log(pseudo_lm.CLASSES) for w in own)
        assert row["n_tokens"] == len(own) and abs(row["score"] - want) < 1e-4


def rng_contexts():
    rng = np.random.default_rng(0)
    return rng.integers(0, pseudo_lm.CLASSES + 1, (20, len(pseudo_lm.SIDES))), rng.integers(0, pseudo_lm.CLASSES, 20)


def test_empty_tables(spark, docs):
    empty = docs(["x"]).where("doc_id < 0")
    items = spark.createDataFrame([], "item_id BIGINT, text STRING")
    messages = spark.createDataFrame([], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    results = [
        bpe_chunks.encode_decode(empty, WORD), repair_files.token_files(empty, BYTE, 2), jaccard_groups.near_duplicates(empty), phrase_index.contamination(empty, items),
        pii.find(empty), secret_scan.find(empty), quality.judged(empty), sharding.sharded(empty), tool_links.linked(messages, tool_links.TOOLS), pseudo_lm.pseudo_likelihood(empty),
    ]
    assert [r.count() for r in results] == [0] * len(results)
    assert phrase_index.contamination(docs(["a b"]), items).first()["n_hit"] == 0


def test_rows_without_an_id(spark):
    table = spark.createDataFrame([(None, "some text here"), (None, None), (3, "some text here")], "doc_id BIGINT, text STRING")
    rows = jaccard_groups.near_duplicates(table).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (0, 0), (3, 3)]
    for frame in (bpe_chunks.encode_decode(table, WORD), repair_files.token_files(table, BYTE, 2), pii.find(table), secret_scan.find(table), quality.judged(table), sharding.sharded(table), pseudo_lm.pseudo_likelihood(table)):
        assert frame.count() == 3


def test_pipeline_stages(spark, docs, tmp_path):
    secret = prose(20)
    good = [prose(90) for _ in range(60)]
    texts = good + [good[0] + " end", prose(70) + " " + secret, good[1] + " mail me@home.org", "too short", None]
    table = docs(texts)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, secret)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    rows = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.dtypes == table.dtypes
        kept[name] = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert set(kept["quality"]) == set(range(1, 64))
    assert set(kept["near_duplicates"]) == set(range(1, 61)) | {62}
    assert set(kept["decontaminate"]) == set(range(1, 61))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(range(1, 61))
