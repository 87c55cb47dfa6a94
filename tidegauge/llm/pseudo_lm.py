"""Document scores by masked pseudo-likelihood.

A small network in numpy predicts the class of each word from two words on either side, the word
itself being masked. Classes are the most frequent words and, for the rest, hash groups; they
are dealt to branches, and a class's probability is that of its branch times that within it, so
that a word costs two short soft-maxes instead of one over all classes. A word's probability is that of its class times the word's share in its class, and a document's
score is the sum of the log-probabilities of its words. Word counts and training cover all
documents: each task trains a copy of the network on its own rows, every word of a text being a
target in one of the rounds, and the copies are averaged by the targets they saw.

The counts of all words are a table that grows with the input. Its most frequent words, KNOWN at
most, are sent to the tasks; the others are joined by word and added up by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import binary, stored, texts_of
from tidegauge.llm.textscan import LOWER, SPACED_WORDS, batches_of, hash_words

SLOTS = 1 << 16
FREQUENT = 192
GROUPS = 64
CLASSES = FREQUENT + GROUPS
HIDDEN = 32
SIDES = (-2, -1, 1, 2)
ROUNDS = 2
KNOWN = 1 << 16
HELD_WORDS = 1 << 20
BATCH = 4096
RATE = 0.01
# The output has two levels: class c is number c // BRANCHES of branch c % BRANCHES.
BRANCHES = 16
SHAPES = {
    "context": (len(SIDES), CLASSES + 1, HIDDEN), "hidden": (HIDDEN,), "branch": (HIDDEN, BRANCHES), "branch_bias": (BRANCHES,),
    "out": (BRANCHES, HIDDEN, CLASSES // BRANCHES), "bias": (BRANCHES, CLASSES // BRANCHES),
}
# Arrays of tasks that one group adds up before the second sum.
PART = 256


def _slots(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(SLOTS - 1)).astype(np.int64)


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of arrays ``(block, part, numbers)`` of float64 over all tasks, ``size`` numbers in blocks.

    PART tasks are added up at a time and then their sums, so no group holds the arrays of all tasks.
    """

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table.column("numbers")[0].as_py()) // 8)
        for numbers in table.column("numbers"):
            total += np.frombuffer(numbers.as_buffer(), dtype=np.float64)
        return pa.table({"block": table.column("block").slice(0, 1), "numbers": binary([total.tobytes()])})

    schema = "block INT, numbers BINARY"
    parts = rows.groupBy("block", "part").applyInArrow(add, schema)
    blocks = parts.groupBy("block").applyInArrow(add, schema).collect()
    sums = [np.frombuffer(r["numbers"], dtype=np.float64) for r in sorted(blocks, key=lambda r: r["block"])]
    return np.concatenate(sums)[:size] if sums else np.zeros(size)


def _blocks(numbers: np.ndarray) -> pa.RecordBatch:
    parts = np.array_split(numbers.astype(np.float64), 64)
    part = pa.array([TaskContext.get().partitionId() // PART] * len(parts), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), part, binary([p.tobytes() for p in parts])], names=["block", "part", "numbers"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: the hash of each word and how often it occurs in all documents."""

    def added(held):
        words, which = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(which, weights=np.concatenate([n for _, n in held]), minlength=len(words)).astype(np.int64)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for low, high in batches_of(batch.column(0)):
                held.append(np.unique(hash_words(batch.column(0).slice(low, high - low), SPACED_WORDS, LOWER)[0], return_counts=True))
                size += len(held[-1][0])
                if size >= HELD_WORDS:
                    held = [added(held)]
                    size = len(held[0][0])
                    if size >= HELD_WORDS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "n"])
                        held, size = [], 0
        if size:
            words, n = added(held)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word BIGINT, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))


def word_classes(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``(class of each hash slot, words of each class)`` from the counts of all words."""
    rows = counts.groupBy(F.col("word").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).agg(F.sum("n").alias("n")).toArrow()
    slots = np.zeros(SLOTS)
    slots[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    classes = FREQUENT + np.arange(SLOTS) % GROUPS
    classes[np.argsort(-slots, kind="stable")[:FREQUENT]] = np.arange(FREQUENT)
    return classes.astype(np.int16), np.bincount(classes, weights=slots, minlength=CLASSES)


def known_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """``(sorted hashes, log-counts, least count)`` of the most frequent words, KNOWN at most: all
    words that occur as often as the least count or more, which is a power of two."""
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect()
    total, least = 0, 1 << 62
    for row in sorted(levels, reverse=True):
        total += row["count"]
        if total > KNOWN:
            break
        least = 1 << row["level"]
    rows = counts.where(F.col("n") >= least).toArrow()
    words = rows.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], np.log(rows.column("n").to_numpy()[order]), least


def start(class_counts: np.ndarray) -> dict[str, np.ndarray]:
    """The network before training: it knows how frequent classes are."""
    rng = np.random.default_rng(7)
    share = ((class_counts + 1) / (class_counts.sum() + CLASSES)).reshape(-1, BRANCHES).T
    branch = share.sum(axis=1)
    model = {name: rng.normal(0, 0.1, SHAPES[name]).astype(np.float32) for name in ("context", "branch", "out")}
    model |= {"hidden": np.zeros(HIDDEN, dtype=np.float32), "branch_bias": np.log(branch).astype(np.float32)}
    return model | {"bias": np.log(share / branch[:, None]).astype(np.float32)}


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[name].ravel() for name in SHAPES])


def shaped(numbers: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = numbers[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def contexts(classes: np.ndarray, first: np.ndarray, chosen=slice(None)) -> np.ndarray:
    """The classes around the words chosen, a column for each side; beyond a text's end stands CLASSES."""
    reach = max(SIDES)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(classes)) + reach * (row + 1)
    spaced = np.full(len(classes) + reach * len(first), CLASSES, dtype=np.int64)
    spaced[place] = classes
    place = place[chosen]
    return np.stack([spaced[place + side] for side in SIDES]).T


def hidden_values(model, around: np.ndarray) -> np.ndarray:
    total = model["context"][0][around[:, 0]] + model["hidden"]
    for k in range(1, len(SIDES)):
        total += model["context"][k][around[:, k]]
    return np.tanh(total, out=total)


def forward(model, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hidden values, log-probabilities of all classes)`` for each context."""
    hidden = hidden_values(model, around)
    logp = np.empty((len(around), CLASSES))
    branch = _normal(model["branch"].T @ hidden.T + model["branch_bias"][:, None])
    for b in range(BRANCHES):
        logp[:, b::BRANCHES] = (branch[b] + _normal(model["out"][b].T @ hidden.T + model["bias"][b][:, None])).T
    return hidden, logp


def _normal(logits: np.ndarray) -> np.ndarray:
    """Log-probabilities of the rows' logits, a column for each context."""
    logits = logits - logits.max(axis=0)
    return logits - np.log(np.exp(logits).sum(axis=0))


def _by_branch(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, bounds)``: targets in the order of their branches; branch b is order[bounds[b]:bounds[b+1]]."""
    branch = (target % BRANCHES).astype(np.uint8)
    return np.argsort(branch, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(branch, minlength=BRANCHES))])


def _leaf_logits(model, hidden: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The logits of the classes of each target's own branch; targets stand in the order of branches."""
    logits = np.empty((CLASSES // BRANCHES, len(hidden)), dtype=np.float32)
    for b in range(BRANCHES):
        low, high = bounds[b], bounds[b + 1]
        logits[:, low:high] = model["out"][b].T @ hidden[low:high].T
        logits[:, low:high] += model["bias"][b][:, None]
    return logits


def target_logp(model, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log-probability of one class for each context: that of its branch plus that within the branch."""
    order, bounds = _by_branch(target)
    hidden, own, place = hidden_values(model, around[order]), target[order], np.arange(len(target))
    logp = np.zeros(len(target), dtype=np.float32)
    for logits, chosen in (
        (model["branch"].T @ hidden.T + model["branch_bias"][:, None], own % BRANCHES), (_leaf_logits(model, hidden, bounds), own // BRANCHES),
    ):
        logits -= logits.max(axis=0)
        logp += logits[chosen, place]
        logp -= np.log(np.exp(logits, out=logits).sum(axis=0))
    out = np.empty_like(logp)
    out[order] = logp
    return out


def _error(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The gradient of the mean loss by the logits, in place."""
    n = logits.shape[1]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    logits[chosen, np.arange(n)] -= 1
    logits /= n
    return logits


def train(model, batches) -> int:
    """Adam over ``(contexts, classes)`` batches, in place; returns the number of targets."""
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    seen = step = 0
    for around, target in batches:
        order, bounds = _by_branch(target)
        around, target, n = around[order], target[order], len(target)
        hidden = hidden_values(model, around)
        branch = _error(model["branch"].T @ hidden.T + model["branch_bias"][:, None], target % BRANCHES)
        leaf = _error(_leaf_logits(model, hidden, bounds), target // BRANCHES)
        back = branch.T @ model["branch"].T
        grads = {
            "context": np.zeros_like(model["context"]), "branch": hidden.T @ branch.T, "branch_bias": branch.sum(axis=1),
            "out": np.empty_like(model["out"]), "bias": np.empty_like(model["bias"]),
        }
        for b in range(BRANCHES):
            low, high = bounds[b], bounds[b + 1]
            back[low:high] += leaf[:, low:high].T @ model["out"][b].T
            grads["out"][b] = hidden[low:high].T @ leaf[:, low:high].T
            grads["bias"][b] = leaf[:, low:high].sum(axis=1)
        back *= 1 - hidden * hidden
        grads["hidden"] = back.sum(axis=0)
        for k in range(len(SIDES)):
            side = around[:, k].astype(np.int16)
            order = np.argsort(side, kind="stable")
            side = side[order]
            starts = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
            grads["context"][k][side[starts]] = np.add.reduceat(back[order], starts)
        step, seen = step + 1, seen + n
        for name, g in grads.items():
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            model[name] -= (RATE * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return seen


def targets_of(own: np.ndarray, first: np.ndarray, turn: int) -> np.ndarray:
    """Which words are targets in a round: each word of a text is one in exactly one of ROUNDS."""
    place = np.arange(len(own)) - np.repeat(first[:-1], np.diff(first))
    return np.flatnonzero(place % ROUNDS == turn)


def trained(docs: DataFrame, classes: np.ndarray, class_counts: np.ndarray) -> dict[str, np.ndarray]:
    """The network from all documents."""
    model = flat(start(class_counts))
    for turn in range(ROUNDS):

        def fit(batches, model=model, turn=turn):
            copy = shaped(model)

            def targets():
                held_x, held_y, size = [], [], 0
                for batch in batches:
                    for low, high in batches_of(batch.column(0), 1 << 20):
                        words, first = hash_words(batch.column(0).slice(low, high - low), SPACED_WORDS, LOWER)
                        own = classes[_slots(words)].astype(np.int64)
                        chosen = targets_of(own, first, turn)
                        held_x.append(contexts(own, first, chosen))
                        held_y.append(own[chosen])
                        size += len(chosen)
                        if size >= BATCH:
                            x, y = np.concatenate(held_x), np.concatenate(held_y)
                            for s in range(0, size - BATCH + 1, BATCH):
                                yield x[s : s + BATCH], y[s : s + BATCH]
                            rest = size // BATCH * BATCH
                            held_x, held_y, size = [x[rest:]], [y[rest:]], size - rest
                if size:
                    yield np.concatenate(held_x), np.concatenate(held_y)

            seen = train(copy, targets())
            yield _blocks(np.append(flat(copy).astype(np.float64) * seen, seen))

        total = _summed(docs.select("text").mapInArrow(fit, "block INT, part INT, numbers BINARY"), len(model) + 1)
        if total[-1]:
            model = (total[:-1] / total[-1]).astype(np.float32)
    return shaped(model)


def class_logp(words: np.ndarray, first: np.ndarray, classes: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """``(class, log-probability of the class)`` of each word."""
    own = classes[_slots(words)].astype(np.int64)
    around = contexts(own, first)
    logp = np.zeros(len(own))
    for s in range(0, len(own), BATCH):
        logp[s : s + BATCH] = target_logp(model, around[s : s + BATCH], own[s : s + BATCH])
    return own, logp


def added_up(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(values)])[first])


def scores(texts: pa.Array, classes: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """``(words, summed log-probability of their classes)`` of each text."""
    words, first = hash_words(texts, SPACED_WORDS, LOWER)
    return np.diff(first), added_up(class_logp(words, first, classes, model)[1], first)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, score, mean_score)`` of every row.

    Null and empty texts have no words, score 0 and no mean. Rows may repeat; an empty table
    gives no rows; other columns are not looked at.
    """
    docs = texts_of(docs)
    counts = stored(word_counts(docs), "word_counts")
    classes, class_counts = word_classes(counts)
    known, known_log, least = known_words(counts)
    model = trained(docs, classes, class_counts)

    def score(batches):
        row = TaskContext.get().partitionId() << 33
        log_class = np.log(np.maximum(class_counts, 1))
        for batch in batches:
            for low, high in batches_of(batch.column(1), 1 << 20):
                words, first = hash_words(batch.column(1).slice(low, high - low), SPACED_WORDS, LOWER)
                own, logp = class_logp(words, first, classes, model)
                logp -= log_class[own]
                at = np.searchsorted(known, words)
                found = np.zeros(len(words), dtype=bool)
                inside = np.flatnonzero(at < len(known))
                found[inside] = known[at[inside]] == words[inside]
                logp[found] += known_log[at[found]]
                others = np.concatenate([[0], np.cumsum(~found)])[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + high - low)), batch.column(0).slice(low, high - low), pa.array(np.diff(first).astype(np.int64)),
                        pa.array(added_up(logp, first)), pa.ListArray.from_arrays(pa.array(others.astype(np.int32)), pa.array(words[~found].view(np.int64))),
                    ],
                    names=["row", "doc_id", "n_tokens", "known", "others"],
                )
                row += high - low

    rows = stored(docs.mapInArrow(score, "row BIGINT, doc_id BIGINT, n_tokens BIGINT, known DOUBLE, others ARRAY<BIGINT>"), "scored")
    # The logarithm of a count of 1 is 0, so words that occur once need no partner.
    others = rows.select("row", F.explode("others").alias("word")).join(counts.where((F.col("n") > 1) & (F.col("n") < least)), "word")
    rest = others.groupBy("row").agg(F.sum(F.log("n")).alias("rest"))
    out = rows.drop("others").join(rest, "row", "left").withColumn("score", F.col("known") + F.coalesce("rest", F.lit(0.0)))
    return out.select("doc_id", "n_tokens", "score", F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")).alias("mean_score"))
