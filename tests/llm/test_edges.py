"""Null, empty, very long, repeated and missing rows through every operator on documents, and the pipeline."""

from __future__ import annotations

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablegate.llm import lm, mixing, neartexts, packing, pii, quality, rules, simhash
from tablegate.llm.queries import TOKENIZER

OPERATORS = {
    "rules": lambda docs, labels: rules.apply_rules(docs, labels),
    "lm": lambda docs, labels: lm.score_documents(docs),
    "mixing": lambda docs, labels: mixing.mix_sources(docs),
    "simhash": lambda docs, labels: simhash.near_duplicates(docs),
    "quality": lambda docs, labels: quality.classify(docs, labels),
    "pii": lambda docs, labels: pii.find_personal(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(odd, none, labels, name):
    assert OPERATORS[name](odd, labels).count() == odd.count()
    assert OPERATORS[name](none, labels).count() == 0


def test_packing_keeps_every_token(odd, none):
    rows = packing.pack(odd, TOKENIZER).collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    whole = [len(encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.select("text").collect()]
    assert sum(r["length"] for r in rows) == sum(whole)
    room = {}
    for r in rows:
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    assert packing.pack(none, TOKENIZER).count() == 0


def test_near_copies_and_empty_texts(odd):
    rows = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert {(i, c) for i, _, c in rows if i in (1, 2)} == {(1, 1), (2, 1)}
    assert {(i, f, c) for i, f, c in rows if i in (3, 4)} == {(3, "0" * 16, 3), (4, "0" * 16, 3)}
    kept = [r["doc_id"] for r in neartexts.keep_one(odd).collect()]
    assert sorted(kept, key=str) == [1, 3, 5, 6, None]


def test_personal_data_is_found_and_replaced(odd):
    found = {r["doc_id"]: r for r in pii.find_personal(odd).collect()}
    text = found[6]["text"]
    spans = [(s["kind"], text[s["start"] : s["end"]]) for s in found[6]["pii"]]
    assert spans == [
        ("email", "a.b@c.org"), ("email", "d@e.f"), ("email", "_g@h.i"), ("phone", "+1 (017) 555-7713"),
        ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"),
    ]
    assert all(not r["pii"] for i, r in found.items() if i != 6)
    clean = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_personal(odd)).collect()}
    assert clean[6] == "mail [email] or [email][email], [phone] and [ip], card [card]"


def test_mixing_targets_and_copies(odd):
    rows = mixing.mix_sources(odd).select("source", "mix.*").collect()
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(total)
    assert all(t <= 3 * sum(r["size"] for r in rows if r["source"] == s) + 1e-6 for s, t in targets.items())
    assert all(0 <= r["copies"] <= 3 for r in rows)
    mixed = mixing.mix_sources(odd)
    assert mixing.emit_copies(mixed).count() == sum(r["copies"] for r in rows)


def test_pipeline_stages(spark, odd, none, tmp_path):
    labelled = spark.createDataFrame([(i, 1, 0) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd.drop("score", "row", "mix", "pii"), none.drop("score", "row", "mix", "pii")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            assert docs.columns == columns or name == "packing"


def test_pipeline_stages_keep_clashing_columns(spark, odd, none, tmp_path):
    """The caller's columns of every name that operators use stay as they are."""
    labelled = spark.createDataFrame([(i, 1, 0) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            if name != "packing":
                assert docs.columns == columns
                assert {(r["score"], r["row"], r["mix"], r["pii"]) for r in docs.collect()} <= {("s", "r", "m", "p")}


def test_stages_take_their_own_working_names(spark, odd):
    docs = odd.withColumnsRenamed({"pii": "__PII", "mix": "__mix"})
    for stage in (corpus_pipeline.personal_data, corpus_pipeline.source_mixing):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns
        assert {(r["__PII"], r["__mix"]) for r in kept.collect()} == {("p", "m")}
