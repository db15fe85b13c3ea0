"""The near-dedup of the pipeline against a comparison of all pairs of whole shingle sets."""

from __future__ import annotations

import random

import pytest

from tablegate.llm import neartexts

WORDS = [f"w{i}" for i in range(3000)]


def shingles(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split() if w]
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset(" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def alike(a, b):
    return not a | b or len(a & b) / len(a | b) >= 0.8


def kept_by_pairs(rows):
    """The id that stays of each group, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted(min(ids) for ids in groups.values())


def worn(base, replaced, draw):
    words = list(base)
    for i in range(replaced):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture
def corpus():
    draw = random.Random(11)
    texts = ["", None, "  \n", "one two", "One\tTWO ", "one two three"]
    for size in (20, 60, 100, 200, 400, 900):
        for _ in range(6):
            base = [draw.choice(WORDS) for _ in range(size)]
            texts += [" ".join(base), " ".join(base).upper()]
            # well over 0.8, well below it, and not alike at all
            texts += [worn(base, max(1, size // 200), draw) for _ in range(3) if size >= 60]
            texts += [worn(base, size // 10, draw), worn(base, size // 2, draw)]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def test_groups_are_those_of_all_pairs(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    kept = neartexts.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_pairs(corpus)


def test_links_are_exact(spark):
    """The candidates of a chain are held to 0.8 by their whole sets: 80 of 100 shingles shared is a link, 79 is none."""
    words = [f"a{i}" for i in range(94)]
    base = " ".join(words)  # 90 shingles
    near = " ".join([*words, *(f"b{i}" for i in range(22))])  # 90 of 112 = 0.804
    far = " ".join([*words, *(f"c{i}" for i in range(23))])  # 90 of 113 = 0.796
    docs = spark.createDataFrame([(1, base), (2, near), (3, far)], "doc_id long, text string")
    nodes = docs.select(neartexts.digest(docs.text).alias("digest"), docs.doc_id.alias("first"))
    by_id = {r["first"]: r["digest"] for r in nodes.collect()}
    links = spark.createDataFrame([(by_id[1], by_id[2]), (by_id[1], by_id[3])], "a long, b long")
    found = neartexts.alike_links(docs, links, nodes, "doc_id", "text").collect()
    assert [tuple(r) for r in found] == [(by_id[1], by_id[2])]


def test_large_groups_lose_no_link(spark, corpus):
    """Groups cut into parts give the components that whole groups give."""
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    texts = neartexts._profiles(docs, "doc_id", "text").dropDuplicates(["digest"])
    texts = neartexts.stored(texts)

    def components(group_rows):
        links = neartexts.candidate_links(texts, group_rows)
        return sorted(map(tuple, neartexts.connected_components(links).collect()))

    assert components(3) == components(neartexts.GROUP_ROWS)


def test_hot_text_and_hot_group(spark):
    """A third of the rows is one text, a third are its near copies; one row of them stays, and every other one."""
    draw = random.Random(4)
    base = [draw.choice(WORDS) for _ in range(150)]
    rows = [(3 * i, " ".join(base)) for i in range(200)]
    rows += [(3 * i + 1, worn(base, 1, draw)) for i in range(200)]
    rows += [(3 * i + 2, " ".join(draw.choice(WORDS) for _ in range(150))) for i in range(200)]
    kept = neartexts.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, *(3 * i + 2 for i in range(200))]


def test_repeated_ids_are_told_apart_by_text(spark):
    draw = random.Random(9)
    one, two = ([draw.choice(WORDS) for _ in range(120)] for _ in range(2))
    rows = [
        (5, " ".join(one), "b"),
        (5, " ".join(one), "a"),
        (5, " ".join(two), "c"),
        (2, worn(two, 1, draw), "d"),
        (None, " ".join(one), "e"),
        (None, " ".join(one), "e"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    for frame in (docs, docs.repartition(4)):
        kept = sorted((str(r["doc_id"]), r["digest"]) for r in neartexts.keep_one(frame).collect())
        assert kept == [("2", "d"), ("5", "a"), ("None", "e"), ("None", "e")]


def test_very_long_text(spark):
    draw = random.Random(1)
    base = [draw.choice(WORDS) for _ in range(150_000)]
    docs = spark.createDataFrame(
        [(1, " ".join(base)), (2, worn(base, 1000, draw)), (3, worn(base, 60_000, draw))], "doc_id long, text string"
    )
    assert sorted(r["doc_id"] for r in neartexts.keep_one(docs).collect()) == [1, 3]
