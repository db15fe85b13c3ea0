"""Registered queries that SQL cannot express, on whole tables, against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

from tablegate.llm import chat, packing, rules
from tablegate.llm.queries import QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name: str, sf_dir: str = SF_DIR) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


@pytest.fixture(scope="module")
def texts():
    return {row["doc_id"]: row["text"] or "" for row in table("documents")}


def by_id(frame, key: str = "doc_id") -> dict:
    rows = frame.collect()
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found


def test_rules_counts(spark, texts):
    found = by_id(QUERIES["op2_certified_rules"](spark, SF_DIR))
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        repeated = {i + j for i, window in enumerate(windows) if times[window] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        row = found[doc_id]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(repeated)
        assert row["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_path_and_certificates():
    """Symbols tell the bad ones; the path takes them first, at the loosest cutoff that catches all."""
    off = tuple(len(grid) for grid in rules.GRIDS.values())
    good = Counter({off: 900, (off[0], 5, off[2], off[3]): 100})
    bad = Counter({(3, *off[1:]): 40, (6, *off[1:]): 10, off: 5, (off[0], 5, off[2], off[3]): 1})
    assert rules.choose_path(good, bad) == [(7, 0, 0, 0)]
    assert rules.choose_path(good, Counter()) == rules.choose_path(Counter(), Counter()) == []
    assert rules.rejected(good, (0, 6, 0, 0)) == 100 and rules.rejected(bad, (7, 0, 0, 0)) == 50


def test_certified_rules_reject_bad_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    quality = {row["doc_id"]: row["quality"] for row in table("labels", sf_dir)}
    judged = QUERIES["op2_certified_rules"](spark, sf_dir).where("NOT base_failed").select("doc_id", "kept").collect()
    shares = {
        label: np.mean([row["kept"] for row in judged if quality.get(row["doc_id"]) == label]) for label in (0, 1)
    }
    assert shares[0] < 0.2 and shares[1] > 1 - rules.ALPHA


def test_language_model_base(spark, texts):
    found = by_id(QUERIES["op3_gated_language_model"](spark, SF_DIR))
    tokens = {doc_id: [*WORD.findall(lower(text)), " "] for doc_id, text in texts.items()}
    counts = Counter(t for doc_id, ts in tokens.items() if crc(doc_id) % 7 != 2 for t in ts)
    total, room = counts.total(), log10(counts.total() + len(counts) + 1)
    assert found.keys() == texts.keys()
    for doc_id, ts in tokens.items():
        row = found[doc_id]
        assert row["held_out"] == (crc(doc_id) % 7 == 2)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(ts), sum(t in counts for t in ts), total)
        assert row["base_score"] == pytest.approx(sum(log10(counts[t] + 1) - room for t in ts), rel=1e-9)
        assert row["score"] < 0


def test_fingerprints_and_components(spark, texts):
    prints = {}
    for doc_id, text in texts.items():
        words = WORD.findall(lower(text))
        width = min(4, len(words))
        shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
        hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], dtype=np.uint64)
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))
    ids, values = list(prints), np.array(list(prints.values()), dtype=np.uint64)
    root = {doc_id: doc_id for doc_id in ids}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for i, doc_id in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4).tolist():
            a, b = find(doc_id), find(ids[j])
            root[max(a, b)] = min(a, b)
    expected = {(i, f"{prints[i]:016x}", find(i)) for i in ids}
    rows = QUERIES["op5_simhash_components"](spark, SF_DIR).collect()
    assert {tuple(row) for row in rows} == expected and len(rows) == len(expected)


def test_conversations(spark):
    turns = defaultdict(list)
    for row in sorted(table("conversations"), key=lambda r: (r["conv_id"], r["turn"])):
        turns[row["conv_id"]].append((row["role"], row["text"] or ""))
    turns[-1] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    found = by_id(QUERIES["op6_chat_examples"](spark, SF_DIR), "conv_id")
    assert found.keys() == turns.keys()
    for conv_id, said in turns.items():
        replies = "".join(text for role, text in said if role == "assistant")
        row = found[conv_id]
        assert (row["n_turns"], row["loss_chars"]) == (len(said), len(replies))
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(replies.encode()).hexdigest()
        formatted = [chat.format_turn(role, text) for role, text in said]
        ends = [i + 1 for i, (role, _) in enumerate(said) if role == "assistant"]
        ends += [len(said)] if not ends or ends[-1] < len(said) else []
        assert row["formatted_chars"] == sum(len("".join(formatted[:end])) for end in ends)


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = by_id(QUERIES["op7_random_indexing_quality"](spark, sf_dir))
    documents = {row["doc_id"] for row in table("documents", sf_dir)}
    assert found.keys() == documents
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    assert all(r["held_out"] == (crc(i) % 5 == 0) for i, r in found.items())
    labelled = [(row["quality"], found[row["doc_id"]]) for row in table("labels", sf_dir) if row["doc_id"] in found]
    held = [row["predicted"] == quality for quality, row in labelled if row["held_out"]]
    assert len(held) > 50 and np.mean(held) > 0.95


def test_packing(spark, texts):
    encode = Tokenizer.from_file(TOKENIZER).encode
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in QUERIES["op9_column_generation_packing"](spark, SF_DIR).collect():
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array([*encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for row in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            at += row["length"]
            assert row["ids_crc32"] == zlib.crc32(ids[row["start"] : at].tobytes())
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE


def luhn(digits: str) -> bool:
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s, d: 12 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15),
    }
    return sorted(
        (m.start(), place, kind, m.end())
        for place, (kind, (pattern, passes)) in enumerate(checks.items())
        for m in re.finditer(pattern, text)
        if passes(m[0], re.sub("[^0-9]", "", m[0]))
    )


def test_personal_data(spark, texts):
    found = by_id(QUERIES["op10_personal_data"](spark, SF_DIR))
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        spans = base_spans(text)
        row, listed = found[doc_id], [f"{kind}:{start}:{end}" for start, _, kind, end in spans]
        counts = Counter(kind for _, _, kind, _ in spans)
        assert all(row[f"n_{kind}"] == counts[kind] for kind in ("email", "ip", "card", "phone"))
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(","))


def test_page_text(spark):
    from html import unescape

    found = by_id(QUERIES["op8_page_text"](spark, SF_DIR), "page_id")
    pages = {row["page_id"]: row for row in table("pages")}
    assert found.keys() == pages.keys()
    for page_id, row in found.items():
        html = pages[page_id]["html"] or ""
        assert (row["url"], row["n_chars"]) == (pages[page_id]["url"], len(row["text"]))
        assert row["text"] == row["text"].strip() and "</" not in row["text"]
        for paragraph in re.findall(r"<article>.*?</article>", html, re.DOTALL)[:1]:
            for inner in re.findall(r"<p>([^<]+)</p>", paragraph):
                assert " ".join(unescape(inner).split()) in row["text"]


def test_page_rows(spark):
    from tablegate.llm.htmltext import extract_main_text

    article = "<article><p>One, two, three.</p><p>" + "word " * 50_000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", article), (3, "u", article), (None, "u", "<p>a")]
    frame = spark.createDataFrame([(*row, "x") for row in rows], "page_id long, url string, html string, text string")
    found = extract_main_text(frame).collect()
    assert Counter((r["page_id"], r["n_chars"]) for r in found) == Counter(
        {(1, 0): 1, (2, 0): 1, (3, 16 + 2 + 249_999): 2, (None, 1): 1}
    )
    assert extract_main_text(frame.limit(0)).count() == 0
