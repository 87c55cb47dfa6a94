"""Prefix trie of conversations as a z-fast trie: its nodes are rows, its look-ups are joins.

A conversation is a string whose letters are turns. A prefix is known by its depth and a hash, the
exclusive or of the hashes of its (place, turn) pairs, so prefixes of all depths come from one
running aggregate that can be cut into blocks.

The compacted trie keeps the nodes where a string ends or where strings part. A node with the
edge (top, bottom] lies in a hash table under its handle, the prefix whose depth is the number in
that range with the most trailing zeros (two-fattest). A string finds its exit node by fat binary
search: each round probes one depth, so a string of n turns needs about log2(n) joins. Strings
come in batches that grow. Those of a batch that part from an edge split it, and only what lies below is grouped
into new nodes; a beginning that many strings share is in the trie after the first, small
batch. In the end the edges are expanded into one node for each depth.

No step brings the turns of one conversation into one task: turns are numbered by a global sort,
and running values are formed over blocks of places first. Every step is written to the shared folder.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

# Of 64 parts of the strings, those up to each number make one batch.
BATCHES = (1, 8, 64)
BLOCK = 4096
# Fixed values of the rebuilding rule.
FAMILY, MOST_SHARED = 100, 6
NOTHING = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "p1", "p2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv_id, k, c1, c2, chars)``: turns by number, their content as two hashes and its length.

    Order is by turn, null first; equal turns go by role and text. Rows without an id belong to no
    conversation. After one global sort the rows of a conversation are runs in neighbouring tasks.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    ordered = rows.orderBy("conv_id", "turn", "role", "text").select(
        "conv_id", F.xxhash64("role", "text").alias("c1"), F.xxhash64("text", F.lit("/"), "role").alias("c2"),
        F.char_length("text").cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("at"),
    )
    placed = stored(ordered, "turns").withColumn("task", F.shiftright("at", 33))
    runs = placed.groupBy("conv_id", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("conv_id", "task", (before - F.col("first")).alias("shift"))
    return placed.join(starts, ["conv_id", "task"]).select("conv_id", (F.col("at") + F.col("shift")).alias("k"), "c1", "c2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conversations, turns)`` of the rebuilding rule: a conversation starts with the first h turns
    of the first one of its hundred, h being its checksum modulo six, and goes on with its own
    turns after h. ``conversations`` holds every id, also of those that have no turns then."""
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h")
    root = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("root")
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = counts.select("conv_id", "n", shared, root).join(counts.select(F.col("conv_id").alias("root"), F.col("n").alias("root_n")), "root", "left")
    convs = convs.select("conv_id", "root", "h", F.least("h", F.coalesce("root_n", F.lit(0))).alias("taken"))
    convs = stored(convs, "conversations")
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("k") < MOST_SHARED - 1)).withColumnRenamed("conv_id", "root")
    taken = convs.join(heads, "root").where("k < h").select("conv_id", (F.col("k") + 1).alias("depth"), "c1", "c2", "chars")
    # Own turns only need the shift of their conversation where its first one is shorter than h.
    shifts = convs.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    own = turns.select("*", shared).where("k >= h").join(shifts, "conv_id", "left")
    own = own.select("conv_id", (F.col("k") + 1 - F.coalesce("less", F.lit(0))).alias("depth"), "c1", "c2", "chars")
    letters = taken.unionByName(own).select(
        "conv_id", "depth", F.xxhash64("depth", "c1", "c2").alias("x1"), F.xxhash64("c2", "depth", "c1").alias("x2"), "chars", F.floor(F.col("depth") / BLOCK).alias("block")
    )
    return convs.select("conv_id"), letters


def prefixes(convs: DataFrame, letters: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ends, strings, prefixes)``.

    ``ends`` names the whole prefix of each conversation, ``strings`` the distinct ones with a
    conversation ``conv`` (the smallest) and their ``copies``. ``prefixes`` has every prefix of each string:
    its hash ``p1, p2``, that of the one before ``q1, q2``, and code points ``before`` and up to it.
    """
    blocks = stored(
        letters.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.sum("chars").alias("chars"), F.count("*").alias("n")), "blocks"
    )
    whole = blocks.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("b1").alias("p1"), F.bit_xor("b2").alias("p2"))
    zero = F.lit(0).cast("bigint")
    ends = stored(convs.join(whole, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in KEY)), "ends")
    strings = stored(ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv"), F.count("*").alias("copies")), "strings")

    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = blocks.join(strings.select(F.col("conv").alias("conv_id")), "conv_id", "left_semi").select(
        "conv_id", "block", F.coalesce(F.bit_xor("b1").over(earlier), zero).alias("s1"), F.coalesce(F.bit_xor("b2").over(earlier), zero).alias("s2"),
        F.coalesce(F.sum("chars").over(earlier), zero).alias("s"),
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = letters.join(seeds, ["conv_id", "block"]).select(
        F.col("conv_id").alias("conv"), "depth", "x1", "x2", "chars",
        F.bit_xor("x1").over(upto).bitwiseXOR(F.col("s1")).alias("p1"), F.bit_xor("x2").over(upto).bitwiseXOR(F.col("s2")).alias("p2"), (F.sum("chars").over(upto) + F.col("s")).alias("upto"),
    )
    rows = rows.select(
        "conv", *KEY, F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), (F.col("upto") - F.col("chars")).alias("before"), "upto"
    )
    return ends, strings, stored(rows, "prefixes")


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zero bits."""
    return F.expr(f"shiftleft(-1L, cast(length(bin({low} ^ {high})) - 1 as int)) & {high}")


def _at(paths: DataFrame, depth: str, **names: str) -> DataFrame:
    """Prefixes to be joined by ``conv`` and a column ``depth``, with new names for their columns."""
    return paths.select("conv", F.col("depth").alias(depth), *(F.col(old).alias(new) for old, new in names.items()))


class ZFastTrie:
    """The compacted trie over the prefixes of strings.

    ``nodes`` (without the root) has ``depth, p1, p2`` of the bottom of each edge, a string ``conv``
    that runs through it, its ``top`` with ``t1, t2``, ``handle`` with ``h1, h2`` and the first prefix of the edge ``f1, f2``.
    """

    def __init__(self, paths: DataFrame):
        self.paths = paths
        self.nodes = None

    def _placed(self, nodes: DataFrame) -> DataFrame:
        """Handles, names and parents of nodes ``(depth, p1, p2, conv, top)``."""
        rows = nodes.withColumn("handle", fattest("top", "depth")).withColumn("begin", F.col("top") + 1)
        rows = rows.join(_at(self.paths, "handle", p1="h1", p2="h2"), ["conv", "handle"])
        return rows.join(_at(self.paths, "begin", p1="f1", p2="f2", q1="t1", q2="t2"), ["conv", "begin"]).select(*KEY, "conv", "top", "t1", "t2", "handle", "h1", "h2", "f1", "f2")

    def _search(self, strings: DataFrame) -> DataFrame:
        """``(conv, depth, met)``: the last node whose handle begins each string, by fat binary search.

        ``met`` is null if it is the root.
        """
        met = "struct<depth:bigint,p1:bigint,p2:bigint,conv:bigint,top:bigint>"
        state = strings.select("conv", "depth", F.lit(0).cast("bigint").alias("low"), F.col("depth").alias("high"), F.lit(None).cast(met).alias("met"))
        table = self.nodes.select("handle", "h1", "h2", F.struct(*KEY, "conv", "top").alias("hit"))
        for _ in range(int(strings.agg(F.max("depth")).first()[0] or 0).bit_length()):
            open_, closed = state.where("low < high"), state.where("low >= high")
            probes = open_.withColumn("handle", fattest("low", "high")).join(_at(self.paths, "handle", p1="h1", p2="h2"), ["conv", "handle"])
            found = probes.join(table, ["handle", "h1", "h2"], "left").select(
                "conv", "depth", F.coalesce("hit.depth", "low").alias("low"), F.when(F.col("hit").isNull(), F.col("handle") - 1).otherwise(F.col("high")).alias("high"), F.coalesce("hit", "met").alias("met")
            )
            state = stored(found.unionByName(closed), "search")
        return state.select("conv", "depth", "met")

    def _exits(self, strings: DataFrame) -> DataFrame:
        """``(conv, shared, edge)``: how many turns of each string lie in the trie, and the edge
        (bottom, its string, top) in which it leaves, null if it leaves at a node."""
        state = self._search(strings)
        # Does the node met lie on the string as a whole? Then the string may go into a child's edge.
        state = state.withColumn("bottom", F.coalesce("met.depth", F.lit(0))).withColumn("begin", F.col("bottom") + 1)
        state = state.join(_at(self.paths, "bottom", p1="b1", p2="b2"), ["conv", "bottom"], "left")
        whole = F.col("met").isNull() | (F.coalesce((F.col("b1") == F.col("met.p1")) & (F.col("b2") == F.col("met.p2")), F.lit(False)))
        state = state.withColumn("whole", whole).join(_at(self.paths, "begin", p1="f1", p2="f2"), ["conv", "begin"], "left")
        children = self.nodes.select(F.col("top").alias("bottom"), "f1", "f2", F.struct(*KEY, "conv", "top").alias("child"))
        state = state.join(children, ["bottom", "f1", "f2"], "left")
        edge = F.when(F.col("whole"), F.col("child")).otherwise(F.col("met")).alias("edge")
        state = stored(state.select("conv", "depth", F.when(F.col("whole"), F.col("bottom")).otherwise(F.col("met.top")).alias("known"), edge), "exits")
        # Along that edge the string and the edge's own string are compared prefix by prefix.
        inside = state.where("edge IS NOT NULL").select("conv", "known", F.least("depth", "edge.depth").alias("last"), F.col("edge.conv").alias("other"))
        walked = inside.join(self.paths.select("conv", *KEY), "conv").where("depth > known AND depth <= last").select("conv", "other", *KEY)
        along = self.paths.select(F.col("conv").alias("other"), *KEY)
        common = walked.join(along, ["other", *KEY], "left_semi").groupBy("conv").agg(F.max("depth").alias("common"))
        return state.join(common, "conv", "left").select("conv", F.coalesce("common", "known").alias("shared"), F.when(F.col("common") < F.col("edge.depth"), F.col("edge")).alias("edge"))

    def insert(self, strings: DataFrame) -> None:
        """Insert a batch of distinct strings ``(conv, depth, p1, p2)`` that are not empty."""
        if self.nodes is None:
            exits = strings.select("conv", F.lit(0).cast("bigint").alias("shared"), F.lit(None).cast("struct<depth:bigint,p1:bigint,p2:bigint,conv:bigint,top:bigint>").alias("edge"))
        else:
            exits = stored(self._exits(strings), "shared")
        below = stored(self.paths.join(exits.select("conv", "shared"), "conv").where("depth > shared").select("conv", *KEY, "q1", "q2", "shared"), "below")
        single = below.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
        parted = single.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
        marks = stored(parted.unionByName(strings.select(*KEY)).distinct(), "marks")
        fresh = stored(single.join(marks, KEY, "left_semi").select(*KEY, "conv"), "fresh")
        # The next mark above on the way of the node's own string, or the place where that string left the trie.
        ways = below.join(fresh.withColumnRenamed("conv", "owner"), KEY).select("conv", *KEY, "owner", "shared")
        above = F.coalesce(F.lag("depth").over(Window.partitionBy("conv").orderBy("depth")), F.col("shared"))
        made = ways.withColumn("top", above).where("conv = owner").select(*KEY, "conv", "top")
        if self.nodes is not None:
            edge = [F.col(f"edge.{c}").alias(c) for c in (*KEY, "conv", "top")]
            cut = exits.where("edge IS NOT NULL").select(*edge, "shared").distinct()
            edges = cut.select(*KEY, "conv", "top").distinct()
            splits = cut.select(F.col("depth").alias("bottom"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), "conv", "top", F.col("shared").alias("depth"))
            whole = edges.select(F.col("depth").alias("bottom"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), "conv", "top", "depth")
            on_edge = F.coalesce(F.lag("depth").over(Window.partitionBy("bottom", "b1", "b2").orderBy("depth")), F.col("top"))
            pieces = splits.unionByName(whole).withColumn("over", on_edge).select("conv", "depth", F.col("over").alias("top"))
            pieces = pieces.join(self.paths.select("conv", *KEY), ["conv", "depth"]).select(*KEY, "conv", "top")
            kept = self.nodes.join(edges.select(*KEY), KEY, "left_anti")
            self.nodes = stored(kept.unionByName(self._placed(made.unionByName(pieces))), "nodes")
        else:
            self.nodes = stored(self._placed(made), "nodes")


def digests(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)``: the ids of the conversations that end at each node, hashed.

    The ids of a node pass through one task in order, as the hash wants it, and none is held.
    """
    names = [*KEY, "ends_sha256"]

    def result(key, hashed):
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([hashed.hexdigest()])], names=names)

    def digest(batches):
        now, hashed = None, None
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), list(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))))
            low = 0
            while low < len(ids):
                high = low + 1
                while high < len(ids) and keys[high] == keys[low]:
                    high += 1
                text = ",".join(map(str, ids[low:high])).encode()
                if keys[low] == now:
                    hashed.update(b"," + text)
                else:
                    if now is not None:
                        yield result(now, hashed)
                    now, hashed = keys[low], hashlib.sha256(text)
                low = high
        if now is not None:
            yield result(now, hashed)

    rows = ends.select("conv_id", *KEY).repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return rows.mapInArrow(digest, "depth BIGINT, p1 BIGINT, p2 BIGINT, ends_sha256 STRING")


def trie(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``
    of every prefix of the rebuilt conversations, from the root down.

    Null roles and texts are empty, rows without a conversation are left out, equal rows are turns
    each, other columns play no part. Very long texts are hashed and measured only. An empty table has no root.
    """
    turns = stored(numbered(conversations), "numbered")
    convs, letters = rebuilt(turns)
    ends, strings, paths = prefixes(convs, stored(letters, "letters"))
    tree = ZFastTrie(paths)
    part, low = F.pmod(F.xxhash64("conv"), F.lit(BATCHES[-1])), 0
    for high in BATCHES:
        batch = strings.where((part >= low) & (part < high) & (F.col("depth") > 0)).select("conv", *KEY)
        low = high
        if not batch.isEmpty():
            tree.insert(batch)

    zero = F.lit(0).cast("bigint")
    root = strings.agg(F.min("conv").alias("conv"), F.sum("copies").alias("n")).where("n > 0")
    top = root.select(*(zero.alias(c) for c in KEY), zero.alias("top"), zero.alias("t1"), zero.alias("t2"))
    if tree.nodes is None:
        nodes = top.withColumn("conv", F.lit(None).cast("bigint"))
    else:
        nodes = tree.nodes.select(*KEY, "conv", "top", "t1", "t2").unionByName(top.withColumn("conv", zero.cast("bigint")))
    nodes = stored(nodes, "trie")
    kids = nodes.where("depth > 0").groupBy(F.col("top").alias("depth"), F.col("t1").alias("p1"), F.col("t2").alias("p2")).agg(F.count("*").alias("n_children"))
    kids = stored(kids, "kids")

    # Every string with the nodes on its way; its own end counts as a leaf if nothing hangs below.
    leaf = strings.join(kids, KEY, "left").select("conv", "copies", F.when(F.col("n_children").isNull(), 1).otherwise(0).alias("leaf"))
    on_way = paths.select("conv", *KEY, "upto").join(nodes.where("depth > 0").select(*KEY, F.col("conv").alias("owner"), "top", "t1", "t2"), KEY)
    on_way = on_way.select("conv", *KEY, "upto", (F.col("conv") == F.col("owner")).alias("own"))
    ways = stored(on_way.unionByName(strings.select("conv", *(zero.alias(c) for c in KEY), zero.alias("upto"), F.lit(False).alias("own"))), "ways")
    members = ways.join(leaf, "conv").groupBy(*KEY).agg(F.sum("copies").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum("leaf").alias("n_leaves"))
    members = stored(members, "members")

    # An edge saves its code points for all members but one. Sums over a subtree: each edge counts on the
    # way of its own string, for every node above.
    by_conv = Window.partitionBy("conv").orderBy("depth")
    saving = ways.withColumn("edge", F.col("upto") - F.coalesce(F.lag("upto").over(by_conv), zero)).join(members.select(*KEY, "n_convs"), KEY)
    saving = saving.withColumn("saved", F.when(F.col("own"), F.col("edge") * (F.col("n_convs") - 1)).otherwise(zero))
    downward = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    saved = saving.withColumn("below", F.sum("saved").over(downward)).groupBy(*KEY).agg(F.sum("below").alias("saved"), F.max(F.when(F.col("own"), F.col("upto"))).alias("upto"), F.sum("saved").alias("own_saved"))
    whole = nodes.join(members, KEY).join(saved, KEY).join(kids, KEY, "left").join(digests(ends), KEY, "left")
    parents = members.select(F.col("depth").alias("top"), F.col("p1").alias("t1"), F.col("p2").alias("t2"), F.col("conv_id").alias("parent_conv_id"))
    whole = stored(whole.join(parents, ["top", "t1", "t2"], "left").select(
        "conv", "top", F.col("depth").alias("bottom"), "conv_id", "parent_conv_id", "n_convs", "n_leaves", F.coalesce("n_children", zero).alias("n_children"),
        (F.col("saved") - F.col("own_saved")).alias("saved_below"), "upto", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    ), "whole")

    def block(column):
        return F.floor(column / BLOCK)

    # Edges expanded, in blocks of depths first.
    edges = whole.where("bottom > 0").withColumn("block", F.explode(F.sequence(block(F.col("top") + 1), block(F.col("bottom")))))
    first, last = F.greatest(F.col("top") + 1, F.col("block") * BLOCK), F.least(F.col("bottom"), F.col("block") * BLOCK + BLOCK - 1)
    edges = edges.withColumn("depth", F.explode(F.sequence(first, last)))
    each = edges.join(paths.select("conv", "depth", "before"), ["conv", "depth"])
    bottom = F.col("depth") == F.col("bottom")
    expanded = each.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("top") + 1, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(bottom, F.col("n_children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("saved_below") + (F.col("n_convs") - 1) * (F.col("upto") - F.col("before"))).alias("saved_tokens"), F.when(bottom, F.col("ends_sha256")).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    above_all = whole.where("bottom = 0").select(
        "conv_id", F.col("bottom").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved_below").alias("saved_tokens"), "ends_sha256"
    )
    return expanded.unionByName(above_all)


# Nodes are the distinct lists of turns; subtrees are lists that begin with the node's.
ORACLE = r"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, i AS c, 0 AS step FROM range(256) AS r(i)
    UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY byte) AS tab FROM bits WHERE step = 8),
own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS w
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
marked AS (
    SELECT conv_id, w, xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: unicode(x)::BIGINT),
        lambda s, b: xor(s // 256, tab[xor(s % 256, b) + 1])), 4294967295) % 6 AS h
    FROM own, crc),
built AS (
    SELECT m.conv_id, coalesce(r.w, [])[1 : m.h] || m.w[m.h + 1 :] AS w
    FROM marked m LEFT JOIN own r ON r.conv_id = m.conv_id - m.conv_id % 100),
steps AS (SELECT conv_id, d, w[1 : d] AS p, w[1 : d - 1] AS up, len(w) = d AS is_end FROM built, unnest(range(0, len(w) + 1)) AS depths(d)),
nodes AS (
    SELECT d, p, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
    FROM steps GROUP BY d, p),
kids AS (SELECT d - 1 AS d, up AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (
    SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.p[nodes.d].text) END AS saved
    FROM nodes LEFT JOIN kids ON kids.d = nodes.d AND kids.p = nodes.p),
subtree AS (
    SELECT a.d, a.p, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved) AS saved
    FROM counted b, unnest(range(0, b.d + 1)) AS above(e) JOIN counted a ON a.d = e AND a.p = b.p[1 : e]
    GROUP BY a.d, a.p)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtree s ON s.d = c.d AND s.p = c.p LEFT JOIN counted u ON u.d = c.d - 1 AND u.p = c.up AND c.d > 0
"""
