"""Benchmark decontamination by a distributed positional inverted index.

The index holds postings (row, position, term) of the training rows, for terms of the test items
that stand within a window's reach of the rarest term of some window; no other posting can take
part in a match. Windows are matched by intersecting lists from their rarest term on, each list
shifted by the term's place in the window: first the rarest term's postings, then those of the
second at the right distance, then the rest. What remains are exact phrase matches. Proximity
matches use the same postings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import lean, slot_bitmap, stored, texts_of
from tidegauge.llm.license_scan import words_sql
from tidegauge.llm.textscan import ALNUM_WORDS, LOWER, batches_of, hash_words, whole_hash, window_hashes

SIZE = 10
SLOTS = 1 << 22
SALTS = 16


def _slots(terms: np.ndarray) -> np.ndarray:
    return (terms & np.uint64(SLOTS - 1)).astype(np.int64)


def _slot(term: str) -> F.Column:
    return F.col(term).bitwiseAND(F.lit(SLOTS - 1)).alias("slot")


def item_windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(item_id, window, terms)``: every window of every item; a shorter item is one window."""

    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            words, first = hash_words(batch.column(1), ALNUM_WORDS, LOWER)
            hashed = window_hashes(words, size).view(np.int64)
            item, window, terms = [], [], []
            for i, (s, e) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                if 0 < e - s < size:
                    item.append(ids[i])
                    window.append(np.uint64(whole_hash(words[s:e])).astype(np.int64).item())
                    terms.append(words[s:e].view(np.int64).tolist())
                for k in range(s, e - size + 1):
                    item.append(ids[i])
                    window.append(int(hashed[k]))
                    terms.append(words[k : k + size].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(window, pa.int64()), pa.array(terms, pa.list_(pa.int64()))],
                names=["item_id", "window", "terms"],
            )

    rows = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(lean(cut), "item_id BIGINT, window BIGINT, terms ARRAY<BIGINT>").where("item_id IS NOT NULL")


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``(slot, n)``: how often words of each slot of the vocabulary occur, over all documents."""
    packed = np.packbits(vocabulary)

    def count(batches):
        wanted = np.unpackbits(packed).astype(bool)
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for low, high in batches_of(batch.column(0)):
                slots = _slots(hash_words(batch.column(0).slice(low, high - low), ALNUM_WORDS, LOWER)[0])
                kept, n = np.unique(slots[wanted[slots]], return_counts=True)
                total[kept] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    return docs.select("text").mapInArrow(lean(count), "slot BIGINT, n BIGINT").groupBy("slot").agg(F.sum("n").alias("n"))


def by_rarity(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``(window, size, ranked)``: the ``(n, place, term)`` of each window that can occur, rarest first."""
    terms = windows.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    known = terms.withColumn("slot", _slot("term")).join(counts, "slot")
    ranked = known.groupBy("window", "size").agg(F.sort_array(F.collect_list(F.struct("n", "place", "term"))).alias("ranked"))
    return ranked.where(F.size("ranked") == F.col("size"))


INDEX = "row BIGINT, doc_id BIGINT, n_words BIGINT, pos BIGINT, term BIGINT"


def index_postings(docs: DataFrame, anchors: np.ndarray, vocabulary: np.ndarray, reach: int) -> DataFrame:
    """The index: one line ``(row, doc_id, n_words)`` for each row of the table, whose ``pos`` is
    null, and its postings ``(row, pos, term)`` of vocabulary terms within ``reach`` of an anchor."""
    packed_a, packed_v = np.packbits(anchors), np.packbits(vocabulary)
    schema = pa.schema([(n, pa.int64()) for n in ("row", "doc_id", "n_words", "pos", "term")])

    def post(batches):
        is_anchor = np.unpackbits(packed_a).astype(bool)
        is_term = np.unpackbits(packed_v).astype(bool)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high in batches_of(texts):
                words, first = hash_words(texts.slice(low, high - low), ALNUM_WORDS, LOWER)
                n = high - low
                rows = row + np.arange(n)
                row += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), ids.slice(low, n), pa.array(np.diff(first)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema
                )
                slots = _slots(words)
                hits = np.flatnonzero(is_anchor[slots])
                if not len(hits):
                    continue
                near = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(near, np.maximum(hits - reach, 0), 1)
                np.add.at(near, np.minimum(hits + reach + 1, len(words)), -1)
                kept = np.flatnonzero((np.cumsum(near)[:-1] > 0) & is_term[slots])
                owner = np.searchsorted(first, kept, side="right") - 1
                k = len(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[owner]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(kept - first[owner]), pa.array(words[kept].view(np.int64))],
                    schema=schema,
                )

    return docs.mapInArrow(lean(post), INDEX)


def phrase_matches(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(row, start, size, window)``: where all terms of a window stand in its order, side by side.

    Lists are intersected from the rarest term on. A term may be in a third of all rows, so the
    first join spreads it over SALTS keys.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    first = F.col("ranked")[0]
    anchors = ranked.select("window", "size", "ranked", first["term"].alias("term"), first["place"].alias("place"), salts)
    found = (
        postings.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(anchors, ["term", "salt"])
        .select("row", (F.col("pos") - F.col("place")).alias("start"), "window", "size", "ranked").where("start >= 0")
    )
    second = F.col("ranked")[1]
    two = found.where("size > 1").withColumn("pos", F.col("start") + second["place"]).withColumn("term", second["term"])
    two = two.join(postings, ["row", "pos", "term"], "left_semi")
    rest = F.explode(F.slice("ranked", 3, F.size("ranked"))).alias("next")
    more = two.where("size > 2").select("row", "start", "window", "size", rest)
    more = more.select("row", "start", "window", "size", (F.col("start") + F.col("next.place")).alias("pos"), F.col("next.term").alias("term"))
    met = more.join(postings, ["row", "pos", "term"], "left_semi").groupBy("row", "start", "window", "size").agg(F.count("*").alias("n"))
    names = ["row", "start", "size", "window"]
    return (
        found.where("size = 1").select(names).unionByName(two.where("size = 2").select(names))
        .unionByName(met.where("n = size - 2").select(names))
    )


def proximity_matches(docs: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """``(pair_id, doc_id, left_pos, right_pos)``: words ``left`` and ``right`` of a pair (pair_id,
    left, right) at most ``distance`` words apart in a text, in either order."""
    docs = texts_of(docs)

    def hashed(batches):
        for batch in batches:
            sides = []
            for column in (1, 2):
                words, first = hash_words(batch.column(column), ALNUM_WORDS, LOWER)
                sides.append(pa.array([int(words[s].view(np.int64)) if e == s + 1 else None for s, e in zip(first[:-1], first[1:])], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *sides], names=["pair_id", "left", "right"])

    pairs = pairs.select(F.col("pair_id").cast("bigint"), "left", "right").mapInArrow(lean(hashed), "pair_id BIGINT, left BIGINT, right BIGINT")
    pairs = stored(pairs.where("left IS NOT NULL AND right IS NOT NULL"), "pairs")
    terms = slot_bitmap(pairs.select(F.explode(F.array("left", "right")).alias("term")).select(_slot("term")), SLOTS)
    index = stored(index_postings(docs, terms, terms, 0), "index")
    rows = index.where("pos IS NULL").select("row", "doc_id")
    postings = index.where("pos IS NOT NULL").select("row", "pos", "term")
    block = F.floor(F.col("pos") / (distance + 1))
    left = postings.withColumnsRenamed({"pos": "left_pos", "term": "left"}).join(pairs, "left")
    left = left.withColumn("block", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.floor(F.col("left_pos") / (distance + 1)) + k)))
    right = postings.withColumn("block", block).withColumnsRenamed({"pos": "right_pos", "term": "right"})
    near = left.join(right, ["row", "block", "right"]).where((F.abs(F.col("left_pos") - F.col("right_pos")) <= distance) & (F.col("left_pos") != F.col("right_pos")))
    return near.join(rows, "row").select("pair_id", "doc_id", "left_pos", "right_pos")


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, matches)`` of every row.

    Words are runs of digits, letters and characters beyond ASCII, lower-cased in A-Z. ``n_hit``
    counts words inside any occurrence of a window of ``size`` item words, ``items`` lists the
    ids of items with such windows and ``matches`` counts the occurrences. Null texts have no
    words; items without words have no window and items without an id are left out; equal rows
    and items count each. An empty table of items marks nothing.
    """
    docs = texts_of(docs)
    cut = stored(item_windows(items, size), "windows")
    windows = cut.select("window", "terms").dropDuplicates(["window"])
    vocabulary = slot_bitmap(cut.select(F.explode("terms").alias("term")).select(_slot("term")), SLOTS)
    ranked = stored(by_rarity(windows, term_counts(docs, vocabulary)), "ranked")
    anchors = slot_bitmap(ranked.select(F.col("ranked")[0]["term"].alias("term")).select(_slot("term")), SLOTS)
    index = stored(index_postings(docs, anchors, vocabulary, size - 1), "index")
    rows = index.where("pos IS NULL").select("row", "doc_id", "n_words")
    postings = index.where("pos IS NOT NULL").select("row", "pos", "term")
    matches = stored(phrase_matches(postings, ranked), "matches")

    ends = F.col("start") + F.col("size")
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select("row", "start", "size").distinct()
    covered = spans.withColumn("seen", F.coalesce(F.max(ends).over(before), F.lit(0)))
    hits = covered.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), ends - F.greatest("start", "seen"))).cast("bigint").alias("n_hit"), F.count("*").alias("matches")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    owners = cut.select("window", "item_id").distinct().select("window", "item_id", salts)
    owned = (
        matches.select("row", "window").distinct().withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        .join(owners, ["window", "salt"]).select("row", "item_id").distinct()
        .groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    return rows.join(hits, "row", "left").join(owned, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("matches", F.lit(0)).alias("matches"),
    )


# Windows are joined as word lists; the words that they cover are unnested and counted.
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {words_sql('text')} AS w FROM documents),
items AS (SELECT item_id, {words_sql('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, size, w[i : i + size - 1] AS g
    FROM (SELECT item_id, w, least(len(w), {SIZE}) AS size FROM items WHERE len(w) > 0), unnest(range(1, len(w) - size + 2)) AS r(i)),
runs AS (
    SELECT row, size, i AS pos, w[i : i + size - 1] AS g FROM docs, (SELECT DISTINCT size FROM windows) AS sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
hits AS (SELECT row, size, pos, item_id FROM runs JOIN windows USING (size, g)),
covered AS (SELECT row, count(DISTINCT pos + j) AS n_hit FROM hits, range({SIZE}) AS r(j) WHERE j < size GROUP BY row),
found AS (SELECT row, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items, count(DISTINCT (pos, size)) AS matches FROM hits GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(len(coalesce(items, [])) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(matches, 0) AS matches
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""
