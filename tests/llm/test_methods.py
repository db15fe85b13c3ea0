"""The methods against plain Python: small helpers, and each registered query on its whole table."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from oracle import connect, difference
from tablegate.llm import chat, components, gru, htmltext, lm, nearest, packing, rules, simhash
from tablegate.llm.queries import ORACLES, QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"
TEXT = st.text(alphabet=st.sampled_from("ab \\.<>[]/sINTSYROLE"), max_size=40)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]"]), TEXT), max_size=5))
def test_chat_round_trip(turns):
    formatted = "".join(chat.format_turn(role, text) for role, text in turns)
    assert chat.parse(formatted) == turns


def test_chat_examples(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, "user", "</s>"), (1, 3, "assistant", "a\\"),
            (1, 4, "user", "tail"), (None, None, None, None), (2, 0, "user", "only")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, example string")
    examples = chat.expand_conversations(frame)
    found = {(r["conv_id"], r["example"]): r for r in examples.collect()}
    assert sorted(found, key=str) == [(1, 0), (1, 1), (1, 2), (2, 0), (None, 0)]
    last = found[1, 1]
    assert chat.unescape(last["text"][last["loss_start"] : last["loss_end"]]) == "a\\"
    assert chat.parse(found[1, 2]["text"])[-1] == ("user", "tail")
    digest = {r["conv_id"]: r for r in chat.digest_examples(examples).collect()}
    assert (digest[1]["n_turns"], digest[1]["loss_chars"], digest[2]["loss_chars"]) == (5, 2, 0)
    assert chat.expand_conversations(frame.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(0, 2**31))
def test_gray_index_finds_all_links(values, seed):
    random = np.random.default_rng(seed)
    near = [v ^ (1 << int(b)) ^ (1 << int(c)) for v in values for b, c in random.integers(0, 64, (6, 2))]
    distinct = np.unique(np.array(values + near, dtype=np.uint64))
    index = simhash.GrayIndex(distinct)
    index.link_all()
    place = {int(v): int(label) for v, label in zip(index.values, index.labels, strict=True)}
    labels = {int(v): i for i, v in enumerate(distinct)}
    for _ in distinct:
        for a in distinct:
            for b in distinct[np.bitwise_count(distinct ^ a) <= 4]:
                low = min(labels[int(a)], labels[int(b)])
                labels[int(a)] = labels[int(b)] = low
        if all(labels[int(a)] == labels[int(b)] for a in distinct for b in distinct[np.bitwise_count(distinct ^ a) <= 4]):
            break
    groups = Counter((place[v], labels[v]) for v in labels)
    assert len(groups) == len({p for p, _ in groups}) == len({q for _, q in groups})


def test_large_groups_are_routed_again(spark, monkeypatch):
    random = np.random.default_rng(5)
    base = random.integers(0, 2**63, 20)
    values = sorted({int(b) ^ (1 << int(i)) for b in base for i in random.integers(0, 62, 30)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    sizes = []
    for most in (500_000, 3):
        monkeypatch.setattr(simhash, "GROUP_ROWS", most)
        roots = components.connected_components(simhash.near_links(frame))
        sizes.append(Counter(r["root"] for r in roots.collect()))
    assert sizes[0] == sizes[1] and len(sizes[0]) == 20


def test_components_of_a_chain(spark):
    links = spark.range(1, 60).selectExpr("id as a", "id - 1 as b")
    assert {r["root"] for r in components.connected_components(links).collect()} == {0}
    assert components.connected_components(links.limit(0)).count() == 0


def test_nearest_with_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.5]), (3, None), (4, []),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (200, [1e-40, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    found = nearest.nearest_neighbours(frame, frame["vec_id"] % 100 == 0)
    by = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by[0] == [1, 1, 2, 200, 100] and by[200] == [0, 1, 1, 100, 2]
    assert nearest.nearest_neighbours(frame.limit(0), frame["vec_id"] % 100 == 0).count() == 0


def test_nearest_with_squares_that_overflow():
    random = np.random.default_rng(4)
    vectors = random.normal(size=(40, 3)) * np.where(np.arange(40) % 2, 1e200, 1.0)[:, None]
    with np.errstate(all="ignore"):
        found = list(nearest.search_block(np.array([0]), vectors[:1], np.arange(40), vectors, 25))
    small = sorted(((vectors[i] - vectors[0]) ** 2).sum() for i in range(2, 40, 2))
    scores = sorted(score for _, _, score in found)
    assert np.allclose(scores[:19], np.sqrt(small)) and np.isinf(scores[19:]).all() and len(found) == 25


def test_exact_binomial_bound():
    assert rules.rejects_at_most(0, 600, 0.005, 0.05) and not rules.rejects_at_most(0, 597, 0.005, 0.05)
    assert not rules.rejects_at_most(0, 0, 0.5, 0.5) and not rules.rejects_at_most(40, 600, 0.05, 0.05)


def test_page_text():
    page = (
        "<html><head><title>T</title></head><body><nav><p>Menu, one, two</p></nav><div class='cookie-notice'>We use</div>"
        "<div id=main><h1>Head &amp; line</h1><p>First <b>bold</b> &#233;,\n two<p>Second<ul><li>item</ul></div>"
        "<div class=comments><p>Nice, post, indeed</p></div><footer>f</footer><script>if(a<b)'</p>'</script><p cla"
    )
    assert htmltext.main_text(page) == "Head & line\n\nFirst bold é, two\n\nSecond\n\nitem"
    assert htmltext.main_text("") == htmltext.main_text("<p></p><!-- open") == ""


@pytest.mark.parametrize(
    "page",
    [
        '<article><img class="header-image" src=x><p>Whole, text.</p></article>',
        "<head><link id=share-css rel=stylesheet></head><body><article><p>Whole, text.</p></article></body>",
        '<div class="content has-sidebar"><article><p>Whole, text.</p></article></div>',
        "<div class='no-sidebar'><p>Whole, text.</p></div>",
        '<article title="the hidden cost"><p data-class="share">Whole, text.</p></article>',
        "<div data-note='aria-hidden=\"true\" display:none'><p>Whole, text.</p></div>",
        "<div class=sidebar><article><p>Whole, text.</p></article></div>",
    ],
)
def test_page_text_is_not_lost_by_names(page):
    assert htmltext.main_text(page) == "Whole, text."


def test_page_text_leaves_out_hidden_and_named():
    page = (
        "<div><p>Whole, text.</p><p hidden>a, b</p><p aria-hidden='true'>c, d</p><p style='display: none'>e, f</p>"
        "<div class='page sidebar'>g, h</div><span class=share-buttons>i</span></div>"
    )
    assert htmltext.main_text(page) == "Whole, text."
    assert htmltext.main_text("<p hidden>a, b</p>") == ""


@settings(max_examples=300, deadline=None)
@example("İ# aİ;")
@given(st.text(alphabet=st.sampled_from("abZé İßΣ'.,!*<|>1 \t\x0b\x1c\xa0中́"), max_size=30))
def test_word_ids_equal_the_tokenizer(text):
    whole = packing.word_ids(TOKENIZER).tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.word_ids(TOKENIZER).encode(text.encode()), dtype="<u4").tolist() == whole


def test_column_generation_covers_all():
    random = np.random.default_rng(1)
    sizes = sorted({int(s) for s in random.integers(1, 129, 30) * 8})
    demand = [int(n) for n in random.integers(1, 500, len(sizes))]
    patterns = packing.solve(sizes, demand)
    packed = Counter()
    for p in patterns:
        assert sum(sizes[i] * n for i, n in p.pieces.items()) <= packing.SEQUENCE
        packed.update({i: n * p.times for i, n in p.pieces.items()})
    assert dict(packed) == dict(enumerate(demand))
    assert sum(p.times for p in patterns) <= 1.02 * sum(s * n for s, n in zip(sizes, demand)) / packing.SEQUENCE + 3


def test_gru_gradients_and_windows():
    random = np.random.default_rng(2)
    weights = gru.start_weights(np.zeros(gru.OUTPUTS), np.zeros((gru.CLASSES, gru.CLASS_WORDS)))
    tokens = random.integers(0, gru.INPUTS, 9)
    trainer = gru.Trainer(weights, 0.0)
    caught = {}
    trainer._update = lambda slopes: caught.update(slopes)
    trainer.stream(tokens, np.arange(9) == 0)
    exact = {k: v.astype(np.float64) for k, v in weights.items()}
    for name, at in (("state", (3, 5)), ("state", (2, 40)), ("inputs", (int(tokens[2]), 20)), ("classes", (1, 2))):
        moved = [{**exact, name: exact[name].copy()} for _ in range(2)]
        for m, step in zip(moved, (1e-3, -1e-3), strict=True):
            m[name][at] += step
        up, down = (-gru.score_texts(m, [tokens])[0] / len(tokens) for m in moved)
        assert caught[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)
    long = random.integers(0, gru.INPUTS, 3 * gru.WINDOW + 5)
    alone, beside = gru.score_texts(weights, [long])[0], gru.score_texts(weights, [tokens, long])[1]
    assert alone == pytest.approx(beside, rel=1e-5)


def plain_logs(weights, tokens, state):
    """Log probabilities of tokens one by one, by the formulas; returns the last state too."""
    w = {k: v.astype(np.float64) for k, v in weights.items()}
    h, last, logs = gru.HIDDEN, gru.END, []
    for token in tokens:
        given, own = w["inputs"][last], state @ w["state"] + w["state_bias"]
        reset, keep = (1 / (1 + np.exp(-(given[a : a + h] + own[a : a + h]))) for a in (0, h))
        fresh = np.tanh(given[2 * h :] + reset * own[2 * h :])
        state = keep * state + (1 - keep) * fresh
        at = int(gru.class_of(np.array([token]))[0])
        logits = state @ w["classes"] + w["class_bias"]
        log = logits[at] - np.log(np.exp(logits).sum())
        if token < gru.VOCABULARY:
            inner = state @ w["words"][at] + w["word_bias"][at]
            log += inner[token % gru.CLASS_WORDS] - np.log(np.exp(inner).sum())
        logs.append(log)
        last = token
    return logs


def test_scores_equal_the_formulas():
    random = np.random.default_rng(4)
    bias = random.normal(5, 3, gru.OUTPUTS), random.normal(5, 3, (gru.CLASSES, gru.CLASS_WORDS))
    weights = {k: v * 3 if k != "class_bias" else v for k, v in gru.start_weights(*bias).items()}
    texts = [np.append(random.integers(0, gru.INPUTS, n), gru.END) for n in (0, 1, 31, 32, 33, 200)]
    expected = [sum(plain_logs(weights, text.tolist(), np.zeros(gru.HIDDEN))) for text in texts]
    assert gru.score_texts(weights, texts) == pytest.approx(expected, rel=1e-4)
    # probabilities far apart
    weights["class_bias"][:5] -= 200
    texts = [np.array([3, 700, gru.END])]
    assert gru.score_texts(weights, texts)[0] == pytest.approx(sum(plain_logs(weights, texts[0].tolist(), np.zeros(gru.HIDDEN))), rel=1e-4)


def test_every_token_trains_once_after_the_word_before_it(monkeypatch):
    """Lanes hold the whole stream; states start anew where texts do, and only a lane's first token has none inside one."""
    random = np.random.default_rng(6)
    texts = [np.append(random.integers(0, 50, n), gru.END) for n in (0, 5, 900, 40, 3000, 1)]
    stream = np.concatenate(texts)
    begins = np.zeros(len(stream), dtype=bool)
    begins[np.cumsum([0, *map(len, texts[:-1])])] = True
    trainer = gru.Trainer(gru.start_weights(np.zeros(gru.OUTPUTS), np.zeros((gru.CLASSES, gru.CLASS_WORDS))), 0.0)
    seen, starts = [], 0

    def window(inputs, tokens, real, goes_on, state):
        seen.append((inputs, tokens, real, goes_on))
        return state

    monkeypatch.setattr(trainer, "_window", window)
    trainer.stream(stream, begins)
    inputs, tokens, real, goes_on = (np.concatenate([s[i] for s in seen]).T for i in range(4))
    assert tokens[real].tolist() == stream.tolist()
    before = np.where(begins, gru.END, np.concatenate([[gru.END], stream[:-1]]))
    assert inputs[real].tolist() == before.tolist()
    assert (goes_on[real] == 0).tolist() == begins.tolist()


def test_words_of_batches_are_those_of_plain_splits(monkeypatch):
    texts = [b"", b"  ", b" A b\x0b\x0cA\x1cb \xc3\x84Z ", b"a\tB\nb\r", "\u00a0 \u2003x".encode(), b"c " * 40]
    monkeypatch.setattr(lm, "BATCH_BYTES", 16)
    batch = pa.record_batch([pa.array([b"cut off", *texts], pa.binary())], names=["raw"]).slice(1)
    found = []
    for piece in lm.pieces(iter([batch, batch.slice(0, 0)])):
        words = lm.Words.of(piece.column("raw"))
        names = [*words.distinct.to_pylist(), lm.END_WORD]
        found += [[names[c] for c in codes] for codes in np.split(words.codes, words.starts[1:])]
    assert found == [[*text.lower().split(), lm.END_WORD] for text in texts]


def test_every_document_trains_in_one_round():
    texts = [b"text %d" % i for i in range(100)]
    rounds = [[zlib.crc32(raw) % lm.ROUNDS == r for r in range(lm.ROUNDS)] for raw in texts]
    assert all(sum(row) == 1 for row in rounds) and all(any(column) for column in zip(*rounds, strict=True))


def test_repeated_words():
    words = b"a b c a b c x a b c".split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    assert rules.repeated_words(words) == len(covered) == 9
    assert re.fullmatch(b"[0-9]+", b"%d" % len(windows))
