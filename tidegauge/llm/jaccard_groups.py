"""N-gram Jaccard join by a token-group matrix.

Documents are sets of hashed word shingles. Similar documents that a task meets together form a
group, and a group stands in the matrix with the union of its members' tokens: of the tokens
that a link cannot avoid (the rarest quarter of a set; any set at 75 % must share one of them).
Two groups that share enough of them are opened. Within an opened pair a document is first held
against the other group's whole token union, and against its members only if that bound leaves
a link possible. Groups that are joined already are not opened again, so copies cost one check
each and not one for each pair. Before groups are paired, each one's overlap with all groups of about
one size together is bounded, and those that cannot reach a link are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import binary, buckets, lean, longs, slot_bitmap, stored, texts_of
from tidegauge.llm.graph import components
from tidegauge.llm.textscan import LOWER, SPACED_WORDS, batches_of, hash_words, whole_hash, window_hashes

WIDTH = 5
PERCENT = 75
COUNTERS = 1 << 20
COUNTER_BLOCK = 1 << 13
GROUP_BYTES = 24 << 20
OPEN_DOCS = 256
ID_SLOTS = 1 << 22
CLASS_RATIO = 1.05
LIST_PART = 512
HELD_PAIRS = 1 << 21
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a short text is one shingle, an empty one none."""
    sets = []
    for low, high in batches_of(texts):
        words, first = hash_words(texts.slice(low, high - low), SPACED_WORDS, LOWER)
        windows = window_hashes(words, width)
        for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
            if end - start >= width:
                sets.append(np.unique(windows[start : end - width + 1]))
            else:
                sets.append(np.array([whole_hash(words[start:end])] if end > start else [], dtype=np.uint64))
    return sets


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    n = len(x) + len(y)
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (n - both)


def most_missed(n: int, percent: int) -> int:
    """How many tokens a linked set of ``n`` tokens must share with its partner, at least."""
    return -(-percent * n // 100)


def slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(COUNTERS - 1)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]):
    """Row blocks of about GROUP_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64).tobytes()


def common_slots(docs: DataFrame, width: int) -> np.ndarray:
    """How common the tokens of each of COUNTERS hash slots are over all documents, as ranks.

    Every token of every document is counted. The table has a fixed size, and so have what tasks
    hand on, what the driver adds up and the table of two bytes a slot that goes back. It only
    orders tokens, rare ones first; any order gives the same links.
    """

    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            sets = shingle_sets(batch.column(0), width)
            if sets:
                total += np.bincount(slots(np.concatenate(sets)), minlength=COUNTERS)
        blocks = total.reshape(-1, COUNTER_BLOCK)
        used = [i for i in range(len(blocks)) if blocks[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), binary([_packed(blocks[i]) for i in used])], names=["block", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(COUNTER_BLOCK, dtype=np.int64)
        for blob in rows.column("counts").to_pylist():
            total += np.frombuffer(blob, dtype=np.uint32 if len(blob) == 4 * COUNTER_BLOCK else np.int64)
        return pa.table({"block": rows.column("block").slice(0, 1), "counts": binary([total.tobytes()])})

    schema = "block INT, counts BINARY"
    summed = docs.select("text").mapInArrow(lean(count), schema).groupBy("block").applyInArrow(add, schema).collect()
    total = np.zeros((COUNTERS // COUNTER_BLOCK, COUNTER_BLOCK), dtype=np.int64)
    for row in summed:
        total[row["block"]] = longs(row["counts"])
    # In eighths of the spread that chance gives the counters.
    mean = total.mean()
    steps = 8 * (total.reshape(-1) - mean) / max(1.0, math.sqrt(mean))
    return np.clip(steps + 128, 0, (1 << 16) - 1).astype(np.uint16)


def _prefix(tokens: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of a set that a linked set must share one of, rare ones first."""
    order = np.argsort(common[slots(tokens)], kind="stable")
    return tokens[order[: len(tokens) - most_missed(len(tokens), percent) + 1]]


def _runs(tokens: np.ndarray, owners: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct owners of each token that has two or more."""
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    tokens, owners = tokens[new], owners[new]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, dtype=np.int64)
    ends = np.r_[starts[1:], len(tokens)]
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        yield owners[s:e]


def needed(low: int, high: int, percent: int) -> int:
    """Tokens that two prefixes share at least if sets of ``low`` and ``high`` tokens link.

    The overlap is at least ``percent (low + high) / (100 + percent)``. Beyond the shorter prefix
    in token order one of the sets has fewer than ``percent`` of its tokens left, rounded up.
    """
    return max(1, -(-percent * (low + high) // (100 + percent)) - most_missed(high, percent) + 1)


def _local_groups(sets: list[np.ndarray], prefixes: list[np.ndarray], percent: int) -> list[int]:
    """The group (its first index) of each set: sets that link with the first set of a shared token."""
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tokens = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.uint64)
    owners = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    shared: dict[tuple[int, int], int] = {}
    for run in _runs(tokens, owners):
        head, *rest = run.tolist()
        for i in rest:
            shared[head, i] = shared.get((head, i), 0) + 1
    for (i, j), n in shared.items():
        sizes = sorted((len(sets[i]), len(sets[j])))
        if n >= needed(*sizes, percent) and top(i) != top(j) and linked(sets[i], sets[j], percent):
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    return [top(i) for i in range(len(sets))]


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the first one and steps of the narrowest width that holds them."""
    values = values.view(np.uint64)
    steps = np.diff(values)
    most = int(steps.max()) if len(steps) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values[:1].tobytes() + steps.astype(f"u{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(blob, dtype=f"u{blob[0]}", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(blob, dtype=np.uint64, offset=1, count=1), steps]), dtype=np.uint64).view(np.int64)


POSTED = "doc_id BIGINT, n_shingles BIGINT, set_id BIGINT, gid BIGINT, print BINARY, bucket INT, tokens BINARY, gids BINARY"


def grouped(docs: DataFrame, common: np.ndarray, width: int, percent: int, n_buckets: int) -> DataFrame:
    """One row for each document, with its set and group, and the matrix in blocks of hash buckets.

    ``set_id`` is the smallest document with the same set in its block of rows, ``gid`` the
    smallest of its group there; ``print`` tells the sets of all blocks apart. A bucket takes the high half of a token's hash, so its blocks hold
    the low half only. Tokens that are equal there by chance raise a pair's count and never lower it.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("gid", pa.int64()), ("print", pa.binary()), ("bucket", pa.int32()), ("tokens", pa.binary()), ("gids", pa.binary())])

    def post(batches):
        for rows in _texts(batches):
            ids = np.array(_column(rows, "doc_id").to_pylist(), dtype=object)
            sets = shingle_sets(_column(rows, "text"), width)
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            owner, kept, seen = [0] * len(ids), [], {}
            for i in order:
                key = sets[i].tobytes()
                if ids[i] is None or not len(sets[i]):
                    owner[i] = -1
                    continue
                if key not in seen:
                    seen[key] = len(kept)
                    kept.append(i)
                owner[i] = seen[key]
            prefixes = [_prefix(sets[i], common, percent) for i in kept]
            groups = _local_groups([sets[i] for i in kept], prefixes, percent)
            set_id = [int(ids[i]) for i in kept]
            gid = [set_id[g] for g in groups]
            n = len(ids)
            prints = [None] * n
            for i in kept:
                prints[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids.tolist(), pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id[o] if o >= 0 else ids[i] for i, o in enumerate(owner)], pa.int64()),
                    pa.array([gid[o] if o >= 0 else ids[i] for i, o in enumerate(owner)], pa.int64()),
                    binary(prints), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                ],
                schema=schema,
            )
            if not kept:
                continue
            tokens = np.concatenate(prefixes)
            owners = np.repeat(np.array(gid, dtype=np.int64), [len(p) for p in prefixes])
            bucket = ((tokens >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((tokens, owners, bucket))
            tokens, owners, bucket = tokens[order], owners[order], bucket[order]
            same = np.zeros(len(tokens), dtype=bool)
            same[1:] = (tokens[1:] == tokens[:-1]) & (owners[1:] == owners[:-1])
            tokens, owners, bucket = tokens[~same], owners[~same], bucket[~same]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[starts[1:], len(bucket)]
            k = len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.nulls(k, pa.int64()) for _ in range(4)), pa.nulls(k, pa.binary()), pa.array(bucket[starts], pa.int32()),
                    binary([tokens[s:e].astype(np.uint32).tobytes() for s, e in zip(starts, ends)]),
                    binary([packed(owners[s:e]) for s, e in zip(starts, ends)]),
                ],
                schema=schema,
            )

    return docs.mapInArrow(lean(post), POSTED)


def shared_lists(posted: DataFrame) -> DataFrame:
    """``(groups, n)``: the lists of groups that share a token, and how many tokens share that list."""

    def meet(rows: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(b, dtype=np.uint32) for b in rows.column("tokens").to_pylist()])
        gids = np.concatenate([unpacked(b) for b in rows.column("gids").to_pylist()])
        lists: dict[bytes, int] = {}
        for run in _runs(tokens, gids):
            key = run.tobytes()
            lists[key] = lists.get(key, 0) + 1
        return pa.table({"groups": pa.array([longs(k).tolist() for k in lists], pa.list_(pa.int64())), "n": pa.array(list(lists.values()), pa.int64())})

    blocks = posted.where("bucket IS NOT NULL").select("bucket", "tokens", "gids")
    return blocks.groupBy("bucket").applyInArrow(meet, "groups ARRAY<BIGINT>, n BIGINT")


def least_shared(low: Column, high: Column, percent: int) -> Column:
    """What ``needed`` is at least for any two sizes from ``low`` to ``high``.

    ``needed`` itself may rise with ``high`` by its rounding. Without rounding it falls, and for
    no pair of sizes in the range it is below the value at the ends, rounded down, plus one.
    """
    return F.greatest(F.lit(1), F.floor(percent * (100 * low - percent * high) / (100 * (100 + percent))) + 1)


def equal_sets(members: DataFrame) -> DataFrame:
    """Links ``(a, b)`` from the smallest group that holds a set to each other group that holds it."""
    first = members.groupBy("print").agg(F.min("gid").alias("a"), F.max("gid").alias("last")).where("a < last").drop("last")
    return members.join(first, "print").where("a < gid").select("a", F.col("gid").alias("b")).distinct()


def between_twins(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """The pairs with each group replaced by the smallest one it has a set in common with."""
    twins = copies.groupBy("b").agg(F.min("a").alias("twin"))
    for side in ("a", "b"):
        pairs = pairs.join(twins.withColumnRenamed("b", side), side, "left").withColumn(side, F.coalesce("twin", side)).drop("twin")
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def qualifying(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, n)`` of groups whose ``n`` shared tokens leave a link possible."""
    pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    a = sizes.select(F.col("gid").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    b = sizes.select(F.col("gid").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    least = least_shared(F.least("a_low", "b_low"), F.greatest("a_high", "b_high"), percent)
    sizes_fit = (100 * F.col("a_high") >= percent * F.col("b_low")) & (100 * F.col("b_high") >= percent * F.col("a_low"))
    return pairs.join(a, "a").join(b, "b").where((F.col("n") >= least) & sizes_fit).select("a", "b")


def reaching_groups(met: DataFrame, percent: int) -> DataFrame:
    """The rows of ``met (list, n, gid, label, low, high)`` whose group may link with one of another label.

    A row of the matrix is a group, a column all groups of about one size. A cell counts the tokens
    that the group shares with any of them, so no single partner shares more. Cells are as many as
    list entries times the few size classes that a link spans; pairs of groups are not formed.
    """
    sized = met.withColumn("class", F.floor(F.log("low") / math.log(CLASS_RATIO)))
    classes = sized.groupBy("list", "n", "class").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.min("low").alias("c_low"), F.max("high").alias("c_high")
    )
    other = (F.col("x") != F.col("label")) | (F.col("y") != F.col("label"))
    sizes_fit = (100 * F.col("c_high") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("c_low"))
    cells = (
        sized.drop("class").join(classes, ["list", "n"]).where(other & sizes_fit).groupBy("gid", "class")
        .agg(F.sum("n").alias("n"), F.least(F.min("low"), F.min("c_low")).alias("low"), F.greatest(F.max("high"), F.max("c_high")).alias("high"))
    )
    reaching = cells.where(F.col("n") >= least_shared(F.col("low"), F.col("high"), percent)).select("gid").distinct()
    return met.join(reaching, "gid", "left_semi")


def _summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    a, b, n, least = (np.concatenate(column) for column in zip(*held))
    order = np.lexsort((b, a))
    a, b, n, least = a[order], b[order], n[order], least[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    return a[starts], b[starts], np.add.reduceat(n, starts), least[starts]


def pairs_across(met: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of groups that share a list, have different labels and share enough tokens.

    Lists that begin with the same group mostly hold the same others, so they are brought together
    and their pairs are added up before they leave the task; what several tasks have of a pair is
    added up after that. Long lists are dealt to several tasks by ``a``, and a task holds
    HELD_PAIRS pairs at most.
    """
    lists = met.groupBy("list", "n").agg(F.sort_array(F.collect_list(F.struct("gid", "label", "low", "high"))).alias("met"), F.min("label").alias("x"), F.max("label").alias("y"))
    lists = lists.where("x < y").select("n", *(F.col(f"met.{c}").alias(c) for c in ("gid", "label", "low", "high")))
    lists = lists.withColumn("first", F.col("gid")[0]).withColumn("parts", F.expr(f"shiftleft(1, cast(ceil(log2(greatest(1, size(gid) / {LIST_PART}))) as int))"))
    dealt = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).repartition("first", "parts", "part")

    def add(batches):
        held, size = [], 0
        for batch in batches:
            gids, labels, lows, highs = (batch.column(c).flatten().to_numpy() for c in ("gid", "label", "low", "high"))
            lengths = np.diff(batch.column("gid").offsets.to_numpy())
            ends = np.cumsum(lengths)
            rows = zip(ends - lengths, ends, *(batch.column(c).to_pylist() for c in ("n", "parts", "part")))
            for start, end, n, parts, part in rows:
                mine = (gids[start:end].astype(np.uint64) * SPREAD >> np.uint64(40)) % np.uint64(parts) == part
                for i in (start + np.flatnonzero(mine)).tolist():
                    low, high = np.minimum(lows[i + 1 : end], lows[i]), np.maximum(highs[i + 1 : end], highs[i])
                    fits = (100 * highs[i + 1 : end] >= percent * lows[i]) & (100 * highs[i] >= percent * lows[i + 1 : end])
                    chosen = np.flatnonzero(fits & (labels[i + 1 : end] != labels[i]))
                    low, high = low[chosen], high[chosen]
                    least = np.maximum(1, percent * (100 * low - percent * high) // (100 * (100 + percent)) + 1)
                    held.append((np.full(len(chosen), gids[i]), gids[i + 1 + chosen], np.full(len(chosen), n), least))
                    size += len(chosen)
                    if size >= HELD_PAIRS:
                        held = [_summed(held)]
                        size = len(held[0][0])
                        if size >= HELD_PAIRS // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held[0]], names=["a", "b", "n", "least"])
                            held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _summed(held)], names=["a", "b", "n", "least"])

    pairs = dealt.select("n", "gid", "label", "low", "high", "parts", "part").mapInArrow(lean(add), "a BIGINT, b BIGINT, n BIGINT, least BIGINT")
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("least").alias("least")).where("n >= least").select("a", "b")


def open_groups(docs: DataFrame, members: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked pairs ``(a, b)`` among group pairs; ``members`` (gid, doc_id) are opened.

    The members of ``a`` are sent to each block of partners of ``a``, and each partner's once.
    Blocks are cut by the number of documents in them.
    """
    counts = members.groupBy("gid").agg(F.count("*").alias("docs"))
    partners = pairs.join(counts.withColumnRenamed("gid", "b"), "b")
    blocks = partners.groupBy("a").agg(F.ceil(F.sum("docs") / OPEN_DOCS).cast("bigint").alias("blocks"))
    placed = stored(partners.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block")), "placed")
    places = placed.select("a", "block", F.col("b").alias("gid")).unionByName(placed.select("a", "block", F.col("a").alias("gid")).distinct())
    wanted = stored(places.join(members, "gid").select("a", "block", "gid", "doc_id"), "wanted")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS))
    bitmap = np.packbits(slot_bitmap(wanted.select(slot.alias("slot")), ID_SLOTS))
    chosen = docs.withColumn("slot", slot)

    def keep(batches):
        bits = np.unpackbits(bitmap).astype(bool)
        for batch in batches:
            kept = batch.filter(pa.array(bits[batch.column("slot").to_numpy(zero_copy_only=False)]))
            yield kept.select(["doc_id", "text"])

    texts = chosen.where("doc_id IS NOT NULL").mapInArrow(lean(keep), "doc_id BIGINT, text STRING")
    rows = texts.join(wanted, "doc_id").select("a", "block", "gid", "text")

    def compare(rows: pa.Table) -> pa.Table:
        head = rows.column("a")[0].as_py()
        groups: dict[int, list[np.ndarray]] = {}
        for gid, tokens in zip(rows.column("gid").to_pylist(), shingle_sets(_column(rows, "text"), width)):
            groups.setdefault(gid, []).append(tokens)
        ours = groups.pop(head, [])
        union = _union(ours)
        found = [gid for gid, theirs in groups.items() if _any_link(ours, union, theirs, percent)]
        return pa.table({"a": pa.array([head] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return rows.groupBy("a", "block").applyInArrow(compare, "a BIGINT, b BIGINT")


def _union(sets: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(sets)) if sets else np.zeros(0, dtype=np.uint64)


def _reaching(sets: list[np.ndarray], union: np.ndarray, percent: int) -> list[np.ndarray]:
    """The sets whose overlap with another group's token union leaves a link possible."""
    return [s for s in sets if len(np.intersect1d(s, union, assume_unique=True)) >= most_missed(len(s), percent)]


def _any_link(ours: list[np.ndarray], union: np.ndarray, theirs: list[np.ndarray], percent: int) -> bool:
    if len(ours) > 1 or len(theirs) > 1:
        theirs, other = _reaching(theirs, union, percent), _union(theirs)
        ours = _reaching(ours, other, percent)
    return any(linked(x, y, percent) for y in theirs for x in ours)


def repeated_ids(placed: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the groups that texts of one document fall into."""
    found = placed.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "gid")
    apart = found.groupBy("doc_id").agg(F.min("gid").alias("a"), F.max("gid").alias("most")).where("a < most").select("doc_id", "a")
    return found.join(apart, "doc_id").where("a < gid").select("a", F.col("gid").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    Lower-cases A-Z, splits at ASCII white space and takes the set of ``width``-word shingles; a
    shorter text is one shingle. Two documents link at ``percent`` of Jaccard similarity or more,
    and ``component_id`` is the smallest id reached by links. Null and empty texts have no
    shingles and link with nothing. Rows that repeat an id count as one document with several
    texts. A row without an id keeps its shingle count and gets no component. An empty table
    gives no rows; other columns are not looked at.
    """
    docs = texts_of(docs)
    spark = docs.sparkSession
    common = common_slots(docs, width)
    posted = stored(grouped(docs, common, width, percent, buckets(spark)), "posted")
    placed = posted.where("bucket IS NULL").select("doc_id", "n_shingles", "set_id", "gid", "print")
    members = placed.where("doc_id = set_id AND n_shingles > 0")
    sizes = members.groupBy("gid").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    lists = shared_lists(posted).groupBy("groups").agg(F.sum("n").alias("n"))
    lists = stored(lists.withColumn("list", F.xxhash64("groups", "n")), "lists")

    # First each group against the smallest one that shares a token; one document stands for each.
    star = lists.select(F.explode(F.slice("groups", 2, F.size("groups") - 1)).alias("b"), F.col("groups")[0].alias("a"), "n")
    # Groups that hold an equal set are linked by it, and only one of them is opened here.
    copies = stored(equal_sets(members), "copies")
    first = stored(between_twins(qualifying(star, sizes, percent), copies), "first")
    heads = members.where("doc_id = gid").select("gid", "doc_id").distinct()
    links = open_groups(docs, heads, first, width, percent).unionByName(copies).unionByName(repeated_ids(placed))
    near = components(links)

    # Then whole groups, where a shared token meets groups that are not joined yet.
    labelled = (
        lists.select("list", "n", F.explode("groups").alias("gid")).join(near.withColumnRenamed("node", "gid"), "gid", "left")
        .select("list", "n", "gid", F.coalesce("label", "gid").alias("label"))
    )
    apart = labelled.groupBy("list", "n").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("list", "n")
    met = stored(labelled.join(apart, ["list", "n"], "left_semi").join(sizes, "gid"), "met")
    # What the first bound leaves out no longer counts for the others in the second.
    met = reaching_groups(stored(reaching_groups(met, percent), "reaching"), percent)
    second = stored(pairs_across(met, percent), "second")
    label_a = near.select(F.col("node").alias("a"), F.col("label").alias("x"))
    label_b = near.select(F.col("node").alias("b"), F.col("label").alias("y"))
    more = open_groups(docs, members.select("gid", "doc_id").distinct(), second, width, percent)
    over = more.join(label_a, "a", "left").join(label_b, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    far = components(over)

    group = placed.drop("print").join(near.withColumnRenamed("node", "gid").withColumnRenamed("label", "near"), "gid", "left")
    group = group.withColumn("near", F.coalesce("near", "gid"))
    group = group.join(far.withColumnRenamed("node", "near").withColumnRenamed("label", "far"), "near", "left")
    return group.select("doc_id", "n_shingles", F.coalesce("far", "near").alias("component_id"))


# All pairs that share a shingle, and what is reached by links.
ORACLE = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
                             ELSE list_distinct([array_to_string(w[i : i + {WIDTH - 1}], ' ') for i in range(1, len(w) - {WIDTH - 2})]) END AS s FROM docs),
shingles AS (SELECT row, doc_id, len(s) AS n, unnest(s) AS g FROM sets WHERE doc_id IS NOT NULL),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS sizes, count(*) AS n
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.row < b.row GROUP BY a.row, b.row, a.doc_id, b.doc_id, a.n, b.n),
pairs AS (SELECT DISTINCT x, y FROM shared WHERE 100 * n >= {PERCENT} * (sizes - n) AND x <> y),
links AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reached(doc_id, other) AS (
    SELECT DISTINCT x, x FROM links UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other),
lowest AS (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id)
SELECT sets.doc_id, len(s) AS n_shingles, coalesce(least, sets.doc_id) AS component_id FROM sets LEFT JOIN lowest ON lowest.doc_id = sets.doc_id
"""
