"""Ranked search of all items at once, against SQL and plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, difference

from tablegate.llm import lexical
from tablegate.llm.queries import ORACLES, QUERIES

NAME = "op13_shared_lexical_search"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert difference(QUERIES[NAME](spark, sf_dir), connect(sf_dir), ORACLES[NAME]) is None


def terms(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(lexical.TERM, lowered)


def brute(docs, items, k=lexical.K):
    """item: [(score, doc_id)] by the definition."""
    words = [(i, terms(text)) for i, text in docs if terms(text)]
    total, length = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    ranked = {}
    for item, asked in wanted.items():
        scored = []
        for i, w in words:
            tf, m = Counter(w), 50 + (50 * len(w) * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in asked & tf.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i))
        if scored:
            ranked[item] = [(-s, i) for s, _, i in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return ranked


def found(spark, docs, items, **more):
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    out: dict = {}
    for row in sorted(lexical.ranked_search(docs, items, **more).collect(), key=lambda r: (str(r.item_id), r.rank)):
        out.setdefault(row.item_id, []).append((row.score, row.doc_id))
        assert row.rank == len(out[row.item_id])
    return out


def test_odd_rows(spark):
    rng = random.Random(5)
    vocabulary = ["the", "of", "Ärger", "ärger", "x1", "STRASSE", "straße", "a", "b"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(9)))) for i in range(80)]
    docs += [(7, "the the x1"), (7, "the the x1"), (None, "the the x1"), (3, None), (4, ""), (5, "-- .!"), (9, "of " * 40_000)]
    items = [(0, "THE of; the"), (1, "Ärger the of x1"), (1, "b"), (2, None), (None, "straße of the"), (4, "zzz"), (5, "")]
    expected = brute(docs, items)
    assert found(spark, docs, items) == expected
    assert set(expected) == {0, 1, None}


def test_blocks_of_items_and_of_documents(spark, monkeypatch):
    """Small blocks give the same rows, ties at the cut included."""
    docs = [(i, "same words in all" if i % 3 else f"w{i % 7} words w{i % 5}") for i in range(300)]
    items = [(i, f"words w{i % 7} same w{i % 4} all") for i in range(30)]
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 20)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 4096)
    assert found(spark, docs, items, k=10) == brute(docs, items, 10)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a")], []) == found(spark, [(1, None)], [(1, "a")]) == {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=8), st.randoms())
def test_shared_plan_gives_plain_sums(queries, rng):
    plan = lexical.mine([(i, b"%d" % t) for i, asked in enumerate(queries) for t in asked])
    weights = np.array([rng.randrange(1, 9000) for _ in plan.terms], dtype=np.int64)
    lengths = np.array([50, 99, 5000])
    docs = [{t: rng.randrange(1, 9) for t in range(len(plan.terms)) if rng.random() < 0.6} for _ in lengths]
    scores = lexical.evaluate(
        plan, weights, lengths, np.array([len(d) for d in docs]),
        np.array([t for d in docs for t in d], dtype=np.int64), np.array([c for d in docs for c in d.values()], dtype=np.int64),
    )
    for place, asked in enumerate(queries):
        numbers = [plan.terms[b"%d" % t] for t in asked]
        for at, doc in enumerate(docs):
            plain = sum(int(weights[t]) * (10**9 * doc[t] // (1000 * doc[t] + 20 * int(lengths[at]))) for t in numbers if t in doc)
            assert scores[place, at] == plain
    assert plan.additions <= sum(len(asked) - 1 for asked in queries)


def test_common_terms_are_added_up_once():
    shared = [b"s%d" % i for i in range(10)]
    pairs = [(i, t) for i in range(50) for t in (*shared, b"own%d" % i, b"odd%d" % (i % 2))]
    plan = lexical.mine(pairs)
    # 9 for the shared set, 1 for each parity with it, 1 for each item's own term
    assert plan.additions == 9 + 2 + 50
    assert sum(len(a) for a, _ in plan.levels) == 2
