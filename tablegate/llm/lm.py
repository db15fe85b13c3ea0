"""Language-model scores of whole documents, learned from the documents themselves.

Counts of all words come from all training documents. The recurrent network
(gru.py) knows the most frequent words; a rarer word is one of a few classes
to it and follows its count within the class. Tasks train copies of the
network on their own documents, the copies are averaged in a tree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm import gru
from tablegate.llm.storage import stored
from tablegate.llm.words import BATCH_BYTES, fold, in_batches, rows_within, text_bytes

FOLDS, HELD_OUT = 7, 2
KNOWN_WORDS = 100_000  # most frequent words that tasks hold with their counts; rarer ones are joined
COUNT_PIECE = 4  # texts whose words are counted before the shuffle, in BATCH_BYTES
ROUNDS = 2  # every training document trains whole in one of them, by the hash of its text
TRAIN_TOKENS = 1 << 19  # tokens that one call of the trainer cuts into lanes
MERGE = 32  # copies of the network that are averaged at once
SLICE = 1 << 14
SCORE_TOKENS = 1 << 22  # tokens scored together
END_WORD = b" "  # no word holds a blank
_SIGNS = frozenset(b"#*$%&|!<>@=\"'()[]{}0123456789")


def rare_class(word: bytes) -> int:
    """One of eight classes, by the make of the word alone."""
    return (word[-1:] in (b".", b",")) + 2 * (not word.isascii()) + 4 * (not _SIGNS.isdisjoint(word))


@dataclass
class Words:
    """Words of some texts in lower case, each once, with the number of every occurrence and of every end.

    ``codes`` follow the texts; the end of a text has the number after the
    last word's. ``lengths`` count the codes of each text, at least one.
    """

    distinct: pa.Array
    codes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, raw: pa.Array) -> Words:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(raw.view(pa.string())))
        words, texts = pc.list_flatten(lists), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(words), 0)  # blanks at either end leave an empty word
        coded = words.filter(real).dictionary_encode()
        counts = np.bincount(np.asarray(texts.filter(real)), minlength=len(raw))
        codes = np.insert(np.asarray(coded.indices), np.cumsum(counts), len(coded.dictionary))
        return cls(coded.dictionary.view(pa.binary()), codes, counts + 1)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths


def pieces(batches: Iterator[pa.RecordBatch], times: int = 1) -> Iterator[pa.RecordBatch]:
    """All rows in order, cut where the texts (``raw``) pass about so many times ``BATCH_BYTES``."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column("raw"))).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // (times * BATCH_BYTES)
        cuts = np.flatnonzero(np.diff(part)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
            if high > low:
                yield batch.slice(low, high - low)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``c`` over all rows of ``raw``; the end of a text counts as ``END_WORD``."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, COUNT_PIECE):
            words = Words.of(piece.column("raw"))
            counts = np.bincount(words.codes, minlength=len(words.distinct) + 1)
            with_end = pa.concat_arrays([words.distinct, pa.array([END_WORD], pa.binary())])
            yield pa.record_batch([with_end, pa.array(counts, pa.int64())], schema=schema)

    return docs.select("raw").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """The frequent words with their counts, as numbers the network knows.

    ``rare_mass`` is the sum of c + 1 over all counted words of a rare class,
    and 1 for a word never seen.
    """

    places: dict[bytes, int]
    counts: np.ndarray
    tokens: np.ndarray
    rare_mass: np.ndarray

    @classmethod
    def of(cls, words: list[tuple[bytes, int]], end_count: int, rare: dict[int, tuple[int, int]]) -> Lexicon:
        """Words by falling count, without the end; ``rare``: count and number of the words beyond them by class."""
        places = {word: i for i, (word, _) in enumerate(words)}
        counts = np.array([c for _, c in words] + [end_count], dtype=np.int64)
        tokens = np.array(
            [i if i < gru.VOCABULARY else gru.END + 1 + rare_class(w) for i, (w, _) in enumerate(words)] + [gru.END]
        )
        mass = np.ones(gru.RARE, dtype=np.int64)
        beyond = tokens > gru.END
        np.add.at(mass, tokens[beyond] - gru.END - 1, counts[beyond] + 1)
        for c, (total, number) in rare.items():
            mass[c] += total + number
        return cls(places, counts, tokens, mass)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the words within them."""
        words = np.zeros(gru.VOCABULARY)
        known = min(len(self.places), gru.VOCABULARY)
        words[:known] = self.counts[:known] + 1
        words = words.reshape(gru.CLASSES, gru.CLASS_WORDS)
        by_class = np.concatenate([words.sum(axis=1), [self.counts[-1] + 1], self.rare_mass])
        # places without a word, and classes without one, keep a share too small to matter
        return np.log(np.maximum(by_class, 1e-3)), np.log(np.maximum(words, 1e-6))

    def numbers(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all codes, and their places (-1: beyond the lexicon)."""
        distinct = words.distinct.to_pylist()
        get = self.places.get
        places = np.array([get(word, -1) for word in distinct] + [len(self.places)], dtype=np.int64)
        tokens = self.tokens[places]
        beyond = np.flatnonzero(places < 0).tolist()
        tokens[beyond] = [gru.END + 1 + rare_class(distinct[i]) for i in beyond]
        return tokens.astype(np.int16)[words.codes], places[words.codes]


def train_round(docs: DataFrame, lexicon: Lexicon, weights: gru.Weights, round_number: int) -> gru.Weights:
    """Every task trains a copy on its documents; copies are averaged by the tokens they saw."""
    schema = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("n", pa.float64()), ("values", pa.binary())])
    columns = "slice int, part long, n double, values binary"
    rate = gru.RATE / (1 + round_number)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gru.keep_memory()
        trainer, held, size = gru.Trainer(weights, rate), [], 0

        def learn() -> None:
            begins = np.zeros(sum(map(len, held)), dtype=bool)
            begins[np.cumsum([0, *map(len, held[:-1])])] = True
            trainer.stream(np.concatenate(held), begins)

        for piece in pieces(batches):
            raws = piece.column("raw")
            chosen = [zlib.crc32(raw) % ROUNDS == round_number for raw in raws.to_pylist()]
            words = Words.of(raws.filter(pa.array(chosen, pa.bool_())))
            for text in np.split(lexicon.numbers(words)[0], words.starts[1:]) if len(words.lengths) else ():
                held.append(text)
                size += len(text)
                if size >= TRAIN_TOKENS:
                    learn()
                    held, size = [], 0
        if held:
            learn()
        if trainer.tokens:
            flat, part = gru.flatten(trainer.weights), TaskContext.get().partitionId()
            rows = [
                (i, part, float(trainer.tokens), flat[low : low + SLICE].tobytes())
                for i, low in enumerate(range(0, len(flat), SLICE))
            ]
            yield from in_batches(iter(rows), schema)

    def average(table: pa.Table) -> pa.Table:
        counts = np.asarray(table.column("n"))
        total = np.zeros(len(table.column("values")[0].as_py()) // 4)
        for n, value in zip(counts, table.column("values"), strict=True):
            total += n * np.frombuffer(value.as_py(), dtype=np.float32)
        mean = (total / counts.sum()).astype(np.float32).tobytes()
        row = (table.column("slice")[0].as_py(), table.column("part")[0].as_py() // MERGE, float(counts.sum()), mean)
        return pa.Table.from_batches(in_batches(iter([row]), schema), schema=schema)

    copies = stored(docs.select("raw").mapInArrow(train, columns))
    parts = (copies.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        copies = copies.groupBy("slice", F.expr(f"part div {MERGE}").alias("of")).applyInArrow(average, columns)
        parts = -(-parts // MERGE)
    # one copy of the network, of a fixed size
    rows = sorted(copies.select("slice", "values").collect())
    if not rows:
        return weights
    flat = np.concatenate([np.frombuffer(value, dtype=np.float32) for _, value in rows])
    return gru.unflatten(flat, weights)


def _frequent(counts: DataFrame) -> tuple[list[tuple[bytes, int]], int, dict[int, tuple[int, int]]]:
    """At most ``KNOWN_WORDS`` most frequent words, the count of ends, and the words beyond them summed by class.

    A histogram of eighths of powers of two gives the least count that keeps
    within the number, so tasks send the driver those words alone.
    """
    words = counts.where(F.col("word") != F.lit(END_WORD))
    ends = counts.where(F.col("word") == F.lit(END_WORD)).first()
    size = F.floor(8 * F.log2("c")).alias("size")
    histogram = words.groupBy(size).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("size"))
    number, least, whole = 0, None, True
    for row in histogram.collect():
        number += row["n"]
        if number > KNOWN_WORDS:
            whole = False
            break
        least = row["least"]
    top = [] if least is None else words.where(F.col("c") >= least).collect()
    top = sorted(((bytes(w), c) for w, c in top), key=lambda entry: (-entry[1], entry[0]))
    rare: dict[int, tuple[int, int]] = {}
    if not whole:
        beyond = words if least is None else words.where(F.col("c") < least)
        schema = pa.schema([("class", pa.int32()), ("c", pa.int64()), ("number", pa.int64())])

        def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((gru.RARE, 2), dtype=np.int64)
            for w, n in rows_within(batches):
                sums[rare_class(w)] += (n, 1)
            yield from in_batches(((i, *s) for i, s in enumerate(sums.tolist())), schema)

        by_class = beyond.mapInArrow(classify, "class int, c long, number long")
        for row in by_class.groupBy("class").agg(F.sum("c").alias("c"), F.sum("number").alias("n")).collect():
            rare[row["class"]] = (row["c"], row["n"])
    return top, ends["c"] if ends else 0, rare


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    Learns from the rows whose crc32(id as text) mod 7 is not 2. A null or
    empty text is one token, its end. Repeated rows count and score each; an
    empty table gives no rows; without training rows every word is unseen.
    Other columns are not read.
    """
    rows = text_bytes(
        docs, text_column, F.col(id_column).cast("long").alias("doc_id"),
        (fold(F.col(id_column), FOLDS) == HELD_OUT).alias("held_out"),
    )
    learning = rows.where(~F.col("held_out"))
    counts = stored(word_counts(learning))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words, ends, rare = _frequent(counts)
    lexicon = Lexicon.of(words, ends, rare)
    weights = gru.start_weights(*lexicon.biases())
    for round_number in range(ROUNDS):
        weights = train_round(learning, lexicon, weights, round_number)
    scored = stored(_scored(rows, lexicon, weights).withColumn("row", F.monotonically_increasing_id()))
    beyond = scored.select("row", F.explode("unknown").alias("word"))
    logs = (
        beyond.join(counts, "word")
        .groupBy("row")
        .agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("known"))
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(logs, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )


def _scored(rows: DataFrame, lexicon: Lexicon, weights: gru.Weights) -> DataFrame:
    """Per row the parts of both scores that need no join, and the words whose counts are still to be joined."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("base", pa.float64()), ("model", pa.float64()), ("unknown", pa.list_(pa.binary())),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru.keep_memory()
        logs = np.append(np.log10(lexicon.counts + 1.0), 0.0)  # place -1: joined later
        known = np.append(lexicon.counts > 0, False)
        mass = np.log10(lexicon.rare_mass.astype(np.float64))
        held: list[tuple[pa.RecordBatch, np.ndarray, Words, np.ndarray]] = []

        def finish() -> Iterator[pa.RecordBatch]:
            texts = [text for _, tokens, words, _ in held for text in np.split(tokens, words.starts[1:])]
            scores, at = gru.score_texts(weights, texts) / np.log(10), 0
            for found, _, words, inner in held:
                model = pa.array(inner + scores[at : at + len(inner)])
                at += len(inner)
                yield pa.record_batch([*found.columns[:5], model, found.column("unknown")], schema=schema)

        size = 0
        for piece in pieces(batches):
            words = Words.of(piece.column("raw"))
            tokens, places = lexicon.numbers(words)
            starts, values, beyond = words.starts, logs[places], places < 0
            rarer = tokens > gru.END
            inner = np.where(rarer, values - mass[np.where(rarer, tokens - gru.END - 1, 0)], 0.0)
            unknown = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.add.reduceat(beyond, starts, dtype=np.int64))]), pa.int32()),
                words.distinct.take(pa.array(words.codes[beyond])),
            )
            n_known = np.add.reduceat(known[places], starts, dtype=np.int64)
            found = pa.record_batch(
                [
                    piece.column("doc_id"), piece.column("held_out"), pa.array(words.lengths, pa.int64()),
                    pa.array(n_known), pa.array(np.add.reduceat(values, starts)), unknown,
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "unknown"],
            )
            held.append((found, tokens, words, np.add.reduceat(inner, starts)))
            size += len(tokens)
            if size >= SCORE_TOKENS:
                yield from finish()
                held, size = [], 0
        yield from finish()

    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, unknown array<binary>"
    return rows.mapInArrow(score, columns)
