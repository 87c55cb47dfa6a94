"""Re-Pair until no pair is frequent, packed numbers, and ranges that expand their own rules only."""

import random
from collections import Counter

import numpy as np

from tidegauge.llm import repair_files as rf

rnd = random.Random(8)


def skewed(n, symbols):
    return np.array([min(int(rnd.paretovariate(0.9)), symbols) for _ in range(n)])


def plain_expansion(rules, base, symbol):
    return [symbol] if symbol < base else plain_expansion(rules, base, rules[symbol - base][0]) + plain_expansion(rules, base, rules[symbol - base][1])


def test_no_frequent_pair_is_left():
    for ids, base in [(skewed(20_000, 400), 500), (np.tile([1, 2, 3, 1], 3000), 9), (np.zeros(70_001, dtype=int), 1), (skewed(3000, 4), 5), (np.arange(40), 40), (np.zeros(0, dtype=int), 3)]:
        rules, sizes, sequence = rf.compress(ids, base)
        assert [x for s in sequence.tolist() for x in plain_expansion(rules.tolist(), base, s)] == ids.tolist()
        assert sizes.tolist() == [len(plain_expansion(rules.tolist(), base, base + r)) for r in range(len(rules))]
        places, last = Counter(), {}
        for i, pair in enumerate(zip(sequence.tolist(), sequence.tolist()[1:])):
            if last.get(pair) != i - 1:
                places[pair] += 1
                last[pair] = i
        assert max(places.values(), default=0) < rf.LEAST_COUNT
        assert len({tuple(r) for r in rules.tolist()}) == len(rules)


def test_smaller_than_sixteen_bits():
    ids = skewed(60_000, 5000)
    rules, sizes, sequence = rf.compress(ids, 5001)
    assert sum(len(rf.packed(x)) for x in (rules.ravel(), sizes, sequence)) < 2 * len(ids)


def test_packed_numbers():
    for values in ([], [0], [1, 0, 1], [2**31 - 1, 5], list(range(rf.PACKED_AT_ONCE + 13)), [7] * (2 * rf.PACKED_AT_ONCE)):
        array = np.array(values, dtype=np.int64)
        assert rf.unpacked(rf.packed(array), len(array)).tolist() == values
    assert len(rf.packed(np.full(8000, 5))) == 1 + 3000


def test_a_range_expands_its_own_rules_only():
    ids = np.concatenate([np.tile([1, 2, 3, 4], 2000), np.tile([5, 6], 50)])
    rules, sizes, sequence = rf.compress(ids, 10)
    lengths = np.concatenate([np.ones(10, dtype=np.int64), sizes])
    pool, starts = rf._pool(rules, lengths, 10, sequence[-2:])
    assert len(pool) < 200 < lengths.sum() and not np.isin(pool, [1, 2, 3, 4]).any()
    assert rf.expand(rules, sizes, sequence, 10, 8050, 8060).tolist() == ids[8050:8060].tolist()
