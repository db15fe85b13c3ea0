"""Personal data: spans and redaction against plain Python, and texts with very many matches."""

from __future__ import annotations

import random
import re
import time
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tablegate.llm import pii, scans

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_base(text: str) -> list[tuple]:
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def spans_of(frame):
    return {r["doc_id"]: [tuple(s) for s in r["pii"]] for r in pii.find_personal(frame).collect()}


def test_base_spans_of_random_texts(spark):
    rng = random.Random(4)
    parts = ["a@b.co", "10.0.0.1", "1.2.3", "256.1.1.1", "4111 1111 1111 1111", "+1 (017) 555-7713", " ", "é", "x.y@z", "@", "+", "7", "-", ".", "5500-0000-0000-0004"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    found = spans_of(frame(spark, texts))
    for i, text in enumerate(texts):
        base = [s for s in found[i] if s[3] in PLAIN]
        assert base == plain_base(text), text
        wide = [s for s in found[i] if s[3] not in PLAIN]
        assert not any(a[0] < b[2] and b[0] < a[2] for a in wide for b in base)


def test_long_runs_are_found_whole(spark):
    key = "Ab3" * 50
    texts = [f"secret key {key} end", f"mail {'n' * 90} [at] {'host' * 20} [dot] org", f"api token {'q' * 500}"]
    rows = {r["doc_id"]: r for r in frame(spark, texts).select("doc_id", pii.found(F.col("text"), "secret").alias("s"), pii.found(F.col("text"), "address").alias("a")).collect()}
    assert [s["span"] for s in rows[0]["s"]] == [key]
    assert [s["span"] for s in rows[1]["a"]] == [texts[1][5:]]
    assert rows[2]["s"] == []


@pytest.mark.parametrize("match", ["10.0.0.{} ", "a{}@b.org, ", "4111 1111 1111 1111; "])
def test_hundred_thousand_matches_in_one_text(spark, match):
    text = "ü" + "".join(match.format(i % 256) for i in range(100_000))
    one = frame(spark, [text])
    base = one.select(F.size(pii.base_spans(F.col("text"))).alias("n"))
    base.collect()
    began = time.time()
    assert base.first()["n"] == 100_000
    assert time.time() - began < 10
    found = pii.find_personal(one)
    row = found.first()
    assert [tuple(s) for s in row["pii"]] == plain_base(text)
    assert pii.redact(found).first()["text"] == redacted(text, row["pii"])


def redacted(text, spans) -> str:
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind']}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def test_redaction_of_overlapping_spans_and_long_texts(spark):
    rng = random.Random(8)
    texts, spans = [], []
    for _ in range(60):
        text = "".join(rng.choices("aé漢𝒳 ", k=rng.choice([0, 5, 4095, 4096, 9000])))
        chosen = sorted((s := rng.randrange(len(text)), 0, min(len(text), s + rng.choice([1, 7, 5000])), "k") for _ in range(rng.randrange(6)) if text)
        texts.append(text)
        spans.append([dict(zip(("start", "rank", "end", "kind"), c, strict=True)) for c in chosen])
    rows = spark.createDataFrame(
        [(i, t, s) for i, (t, s) in enumerate(zip(texts, spans, strict=True))],
        "doc_id long, text string, pii array<struct<start:int,rank:int,end:int,kind:string>>",
    )
    got = {r["doc_id"]: r["text"] for r in pii.redact(rows).collect()}
    for i, (text, chosen) in enumerate(zip(texts, spans, strict=True)):
        assert got[i] == redacted(text, chosen)


def test_running_values_and_search(spark):
    rng = random.Random(2)
    rows = [([rng.randrange(100) for _ in range(n)],) for n in (0, 1, 2, 255, 256, 257, 1000)]
    some = spark.createDataFrame(rows, "v array<int>")
    for values, total, most, below in some.select(
        "v", scans.running_sum(F.col("v")), scans.running_max(F.col("v")), scans.count_below(F.array_sort("v"), F.lit(50))
    ).collect():
        assert total == list(accumulate(values)) and most == list(accumulate(values, max))
        assert below == sum(v < 50 for v in values)
