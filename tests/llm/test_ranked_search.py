"""The search over bit-sliced signatures against plain scoring, on odd rows and on empty tables."""

from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from tallyfield.llm import bitslices, blocks
from tallyfield.llm.common import ALNUM, Words

COLUMNS = ["item_id", "rank", "doc_id", "score"]


@pytest.fixture(scope="module")
def asked(docs):
    """Items from stretches of documents, with ties, repeats, NULLs, empty and very long texts."""
    texts = [t for _, t in docs if t and len(t) > 40]
    rows = [(i, " ".join(t.split()[i % 3 : i % 3 + 12]).swapcase() if i % 2 else t[5:90]) for i, t in enumerate(texts[:60])]
    return rows + [(7, "other words under one id"), rows[3], rows[3], (100, None), (101, ""), (102, "!!! ..."), (None, texts[0]), (103, texts[1] * 50), (104, "zzzzqq")]


@pytest.fixture(scope="module")
def items(spark, asked):
    return spark.createDataFrame([(*r, "z", "z", 1) for r in asked], "item_id long, text string, _term string, _item string, rank int").repartition(2)


def test_ranking(table, docs, items, asked, nothing, monkeypatch):
    want = brute.ranking(docs, asked)
    assert len(want) > 300
    assert Counter(tuple(r) for r in bitslices.ranked(table, items).select(COLUMNS).collect()) == want
    # narrow signatures, small blocks of both sides: more documents pass the bound, the result is the same
    for name, value in {"BITS": 2, "DOCUMENTS": 9, "ITEM_TERMS": 50, "COUNTED": 100, "WIDEST": 64}.items():
        monkeypatch.setattr(bitslices, name, value)
    assert Counter(tuple(r) for r in bitslices.ranked(table, items).select(COLUMNS).collect()) == want
    monkeypatch.setattr(bitslices, "OPEN", 2)
    monkeypatch.setattr(blocks, "SMALL", 0)
    assert Counter(tuple(r) for r in bitslices.ranked(table, items).select(COLUMNS).collect()) == want
    assert bitslices.ranked(nothing, items).collect() == []
    assert bitslices.ranked(table, items.limit(0)).collect() == []


def test_bounds_are_never_too_small():
    random = np.random.default_rng(2)
    terms, many = random.integers(1, 2**63, 400, dtype=np.uint64), random.integers(1, 40, 400)
    owner = np.sort(random.integers(0, 30, 400))
    packed = bitslices.signatures(terms, many, owner, 900, 30)
    steps = bitslices.reached(packed, terms, 30)
    size = np.bincount(owner, many, 30).astype(np.int64) + 1
    m = random.integers(10, 300, 30)
    most = bitslices.bounds(m, size)
    for i in range(400):
        assert most[steps[i, owner[i]], owner[i]] >= bitslices.share(many[i], m[owner[i]])


def test_terms_of_repeating_bytes_differ():
    """Strings on which a polynomial modulo a power of two collides for every base."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    x, y, z = bitslices.term_hashes(Words(pa.array([a, b, a.upper()]), ALNUM))
    assert x != y and x == z
