"""Hashes of words and stretches: exact arithmetic, and strings on which weaker sums collide."""

import numpy as np
import pyarrow as pa

from tallyfield.llm import common, fmindex, linededup
from tallyfield.llm.common import PRIME, SPACED, Sequences, Words


def paired_up(a, b, n=1024):
    """A pattern of two things in which every halving swaps them, and the same with both exchanged."""
    first = [(a, b)[bin(i).count("1") % 2] for i in range(n)]
    return first, [b if x == a else a for x in first]


def test_arithmetic_modulo_the_prime():
    random = np.random.default_rng(0)
    a, b = (np.r_[random.integers(0, PRIME, 500, dtype=np.uint64), [0, 1, PRIME - 1]].astype(np.uint64) for _ in range(2))
    assert [int(x) for x in common.times(a, b)] == [int(x) * int(y) % PRIME for x, y in zip(a, b)]
    values = random.integers(0, 2**64, 300, dtype=np.uint64)
    for which in (0, 1):
        sums, base = Sequences(values, which), common.BASES[which]
        poly = lambda v: sum(int(x) * pow(base, i, PRIME) for i, x in enumerate(v)) % PRIME  # noqa: E731, B023
        start, end = np.array([0, 5, 17, 0, 299]), np.array([300, 6, 17, 12, 300])
        assert [int(x) for x in sums.plain(start, end)] == [poly(values[a:b]) for a, b in zip(start, end)]
        gap = np.array([100, 5, 3])
        whole = Sequences(np.delete(values, 100), which).of(np.array([0]), np.array([299]), 21)
        assert sums.without(np.array([0]), gap[:1], np.array([300]), 21) == whole
        assert sums.without(np.array([0]), np.array([299]), np.array([300]), 3) == sums.of(np.array([0]), np.array([299]), 3)


def test_paired_patterns_have_different_hashes():
    x, y = ("".join(p) for p in paired_up("a", "b", 4096))
    words = Words(pa.array([x, y]), SPACED)
    assert words.hashes[0] != words.hashes[1]
    x, y = (" ".join(p) for p in paired_up("a", "b", 4096))
    words = Words(pa.array([x, y]), SPACED)
    for which in (0, 1):
        sums = Sequences(words.hashes, which)
        assert sums.plain(np.array([0]), np.array([4096])) != sums.plain(np.array([4096]), np.array([8192]))


def test_texts_of_paired_patterns_are_not_repeats(spark):
    x, y = ("".join(p) for p in paired_up("a", "b"))
    rest = [f"w{i}" for i in range(59)]
    docs = [(1, " ".join(rest[:30] + [x] + rest[30:])), (2, " ".join(rest[:30] + [y] + rest[30:]))]
    out = fmindex.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in out.collect()) == [(1, 60, 0), (2, 60, 0)]


def test_lines_of_paired_patterns_are_not_repeats(spark):
    x, y = (" ".join(p) for p in paired_up("a", "b"))
    out = linededup.line_report(spark.createDataFrame([(1, x), (2, y), (3, x)], "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_removed"]) for r in out.collect()) == [(1, 0), (2, 0), (3, 1)]
