"""License scans against a plain search of the words."""

from __future__ import annotations

import random
import re

import pyarrow.parquet as pq
import pytest

from tablegate.llm import licenses
from tablegate.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, label string, row string, template string"
MIT = next(t for t in licenses.TEMPLATES if t.label == "mit" and t.whole)


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(said: list[str], phrase: str) -> list[int]:
    asked = phrase.split()
    return [i for i in range(len(said) - len(asked) + 1) if said[i : i + len(asked)] == asked]


def check(rows, texts):
    """Base columns and phrase labels of the query against the definition."""
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, texts))
    for row in rows:
        said = words(texts[row["doc_id"]])
        base = {t.label: places(said, t.text) for t in licenses.BASE}
        starts = [p for found in base.values() for p in found]
        assert row["n_words"] == len(said)
        assert row["n_base"] == len(starts)
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted(label for label, found in base.items() if found))
        phrases = {t.label for t in licenses.TEMPLATES if not t.whole and places(said, " ".join(w.decode() for w in t.words))}
        labels = set(row["labels"].split(",")) - {""}
        assert labels >= phrases and labels - phrases <= {t.label for t in licenses.TEMPLATES if t.whole}
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(labels)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_whole_tables(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/documents.parquet").to_pylist()
    rows = QUERIES["op12_license_diagonals"](spark, f"/root/testdata/{sf}").collect()
    check(rows, {r["doc_id"]: r["text"] for r in table})
    assert any(r["n_base"] for r in rows)


def matches(spark, *texts):
    rows = [(i, text, "l", "r", "t") for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r["doc_id"]: [(m["label"], m["start"], m["end"], m["share"]) for m in r["matches"]] for r in licenses.find_licenses(frame).collect()}


def test_phrases_at_every_place(spark):
    found = matches(
        spark, "mit license, MIT-License mit. license", "cc by cc by nc", "mit", None, "", "gnu general public general public license",
        "mit lizenz license mit", "Ümit license Mit\x00license", "apache license " * 20_000,
    )
    assert found[0] == [("mit", 0, 2, 1.0), ("mit", 2, 4, 1.0), ("mit", 4, 6, 1.0)]
    assert found[1] == [("cc-by", 0, 2, 1.0), ("cc-by", 2, 4, 1.0), ("cc-by-nc", 2, 5, 1.0)]
    assert found[2] == found[3] == found[4] == found[5] == found[6] == []
    assert found[7] == [("mit", 2, 4, 1.0)]
    assert len(found[8]) == 20_000 and found[8][-1] == ("apache", 39_998, 40_000, 1.0)


def changed(text: str, rng: random.Random, times: int) -> str:
    """Words added, left out and replaced, at some distance from each other."""
    said = text.split()
    step = len(said) // times
    for k in reversed(range(times)):
        at = k * step + rng.randrange(step // 2)
        rng.choice([lambda: said.insert(at, "foo bar"), lambda: said.pop(at), lambda: said.__setitem__(at, "baz")])()
    return " ".join(said)


def test_changed_texts_are_merged_from_diagonals(spark):
    rng = random.Random(9)
    texts = [f"a b {MIT.text} c", f"x {MIT.text} {MIT.text} y", *(f"see {changed(MIT.text, rng, 2)} end" for _ in range(10))]
    half = " ".join(MIT.text.split()[: len(MIT.text.split()) // 2])
    shuffled = MIT.text.split()
    rng.shuffle(shuffled)
    found = matches(spark, *texts, half, " ".join(shuffled))
    size = len(MIT.words)
    assert found[0] == [("mit", 2, 2 + size, 1.0)]
    assert found[1] == [("mit", 1, 1 + size, 1.0), ("mit", 1 + size, 1 + 2 * size, 1.0)]
    for i in range(2, 12):
        assert [label for label, *_ in found[i]] == ["mit"], texts[i]
        (_, start, end, share), = found[i]
        assert licenses.SHARE <= share <= 1 and start >= 1 and abs(end - start - size) <= 6
    assert found[12] == found[13] == []


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "mit license", "", "", "")] * 3 + [(None, "cc by", "", "", "")], SCHEMA)
    rows = licenses.find_licenses(frame).collect()
    assert sorted((str(r["doc_id"]), r["matches"][0]["label"]) for r in rows) == [("1", "mit")] * 3 + [("None", "cc-by")]
    assert licenses.find_licenses(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        licenses.find_licenses(frame, [licenses.Template("x", "one")])
