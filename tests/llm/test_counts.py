"""What the quality rules and the quality classifier count: draws of the certificates, neighbours of words."""

from __future__ import annotations

import numpy as np
import pytest

from tablegate.llm import quality, rules

SYMBOLS = " #|#|#|#|#|#|#|#|#|#|#|#|#|#|"


def test_repeated_documents_are_one_draw(spark):
    """A table that holds every document many times certifies no more than the table itself."""
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"{words} d{i}" + (SYMBOLS if i % 3 == 0 else ""), "en") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 <> 0) AS quality")

    def cutoffs(frame):
        counts = rules.count_texts(frame, "doc_id", "text", rules.stratum_of(frame["lang"]))
        return rules.certified_cutoffs(counts, labels)

    many = docs
    for _ in range(5):
        many = many.unionAll(many)
    assert cutoffs(docs) == cutoffs(many) == {}


@pytest.mark.parametrize("length", [1, 2, 6, 7, 8, 13, 14, 15, 40])
def test_neighbours_at_a_cut_count_once(monkeypatch, length):
    monkeypatch.setattr(quality, "CHUNK", 7)
    texts = [" ".join(f"w{i % 11}" for i in range(length)).encode(), b"", b"a b"]
    found: dict[tuple[int, int], int] = {}
    for chunk in quality._chunks(iter(texts)):
        for a, b in zip(chunk[:-1].tolist(), chunk[1:].tolist(), strict=True):
            if quality.BUCKETS not in (a, b):
                found[a, b] = found.get((a, b), 0) + 1
    wanted: dict[tuple[int, int], int] = {}
    for raw in texts:
        buckets = quality.word_buckets(raw).tolist()
        for pair in zip(buckets, buckets[1:], strict=False):
            wanted[pair] = wanted.get(pair, 0) + 1
    assert found == wanted
    assert np.array_equal(quality.word_buckets(b""), [])
