"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a text whose measure exceeds its cutoff. A fifth of the
labelled documents chooses a path: one cutoff after the other is tightened,
each time the one that costs the fewest good documents per bad one. The other
labels certify it, stratum by stratum: from the loosest step on, an exact
binomial test bounds the share of good documents that all rules together
reject, and the first step without a certificate ends the walk. The path is
fixed before the certifying labels are seen, so the steps of a stratum need no
correction among each other; Bonferroni over the strata keeps all certificates
right together with the confidence asked for. Without a certificate a
stratum's rules reject nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.storage import stored
from tablegate.llm.words import continuation_bytes, fold, in_batches, rows_within, text_bytes

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
STRATA = ("en", "fr", "de", "es")
ALPHA = 0.02  # share of good documents that all rules together may reject in a stratum
DELTA = 0.05  # chance that any certificate of any stratum is wrong
CHOOSE_EVERY = 5  # ids whose crc32 mod this is 0 choose the path, the others certify

# Cutoffs of each measure from loose to strict: part of the rule, not learned.
GRIDS = {
    "symbols_per_char": (0.9, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02),
    "repeated_words": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "duplicate_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "capitals": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
}

SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters")


def count_text(raw: bytes) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` for one whole text."""
    words = raw.split()
    blanks = len(raw) - sum(map(len, words))
    lines = seen = 0
    earlier: set[bytes] = set()
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            seen += line in earlier
            earlier.add(line)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    small = len(raw) - len(raw.translate(None, _SMALL))
    return (
        len(words),
        len(raw) - continuation_bytes(raw) - blanks,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        seen,
        repeated_words(words),
        lines,
        capitals,
        capitals + small,
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, each counted once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def count_texts(docs: DataFrame, id_column: str, text_column: str, stratum: Column) -> DataFrame:
    """Id, stratum and the counts of every row's text; a null text is empty."""
    frame = text_bytes(docs, text_column, F.col(id_column).cast("long").alias("doc_id"), stratum.alias("stratum"))
    kinds = ", ".join(f"{name} long" for name in COUNTS)
    schema = pa.schema([("doc_id", pa.int64()), ("stratum", pa.int32()), *((name, pa.int64()) for name in COUNTS)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(((i, s, *count_text(raw)) for i, s, raw in rows_within(batches)), schema)

    return frame.mapInArrow(count, f"doc_id long, stratum int, {kinds}")


def measures() -> dict[str, Column]:
    """The measure of each rule, 0 where it is undefined."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return {
        "symbols_per_char": share("n_symbols", "word_chars"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "capitals": share("n_capitals", "n_letters"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def stratum_of(lang: Column, strata: tuple[str, ...] = STRATA) -> Column:
    """Place of the language in ``strata``; any other, or null, is the last stratum."""
    place = F.lit(len(strata))
    for i, name in enumerate(strata):
        place = F.when(lang == name, i).otherwise(place)
    return place.cast("int")


def rejects_at_most(rejected: int, good: int, alpha: float, delta: float) -> bool:
    """Exact binomial test: P(Bin(good, alpha) <= rejected) <= delta."""
    if good == 0 or rejected > good * alpha:
        return False
    step, odds = good * math.log1p(-alpha), math.log(alpha) - math.log1p(-alpha)
    tail = 0.0
    for k in range(rejected + 1):
        tail += math.exp(step)
        if tail > delta:
            return False
        step += math.log(good - k) - math.log(k + 1) + odds
    return True


Levels = tuple[int, ...]


def level(measure: Column, grid: tuple[float, ...]) -> Column:
    """Place of the loosest cutoff that rejects, the number of cutoffs if none does."""
    return F.lit(len(grid)) - F.size(F.filter(F.array(*(F.lit(cutoff) for cutoff in grid)), lambda c: measure > c))


def rejected(counts: Mapping[Levels, int], setting: Levels) -> int:
    """How many of the counted documents any rule rejects; a setting is the number of cutoffs in use per rule."""
    return sum(n for levels, n in counts.items() if any(at < used for at, used in zip(levels, setting, strict=True)))


def choose_path(good: Mapping[Levels, int], bad: Mapping[Levels, int]) -> list[Levels]:
    """Settings from loose to strict; each tightens one rule where that costs the fewest good documents per bad one.

    Ties go to the step that rejects more, then to the earlier rule, then to
    the looser cutoff. It ends when no step rejects more bad documents than
    good ones.
    """
    sizes = [len(grid) for grid in GRIDS.values()]
    setting, path = (0,) * len(sizes), []
    while True:
        lost, caught = rejected(good, setting), rejected(bad, setting)
        steps = []
        for rule, size in enumerate(sizes):
            for used in range(setting[rule] + 1, size + 1):
                tried = (*setting[:rule], used, *setting[rule + 1 :])
                gain, cost = rejected(bad, tried) - caught, rejected(good, tried) - lost
                if gain > cost:
                    steps.append((cost / gain, -gain, rule, used, tried))
        if not steps:
            return path
        setting = min(steps)[-1]
        path.append(setting)


def certified_cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[tuple[int, str], float]:
    """Cutoff of every stratum and rule that has a certificate.

    Reads all labelled documents that pass the base rules. What reaches the
    driver is one count per stratum, half, label and combination of levels:
    bounded by the grids, whatever the input. An id that is labelled good and
    bad counts as good, one labelled twice counts once. Rows repeated under
    one id are one draw of their stratum, as bad as the worst of them.
    """
    marked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    labelled = counts.where(~base_failed()).join(marked, "doc_id")
    levels = [level(measure, GRIDS[rule]).alias(rule) for rule, measure in measures().items()]
    chooses = (fold(F.col("doc_id"), CHOOSE_EVERY) == 0).alias("chooses")
    draws = labelled.select("doc_id", "stratum", "quality", *levels).groupBy("doc_id", "stratum", "quality")
    known = draws.agg(*(F.max(rule).alias(rule) for rule in GRIDS))
    grouped = known.select("stratum", "quality", chooses, *GRIDS).groupBy("stratum", "quality", "chooses", *GRIDS)
    choosing: dict[int, Counter[Levels]] = {0: Counter(), 1: Counter()}
    certifying: dict[int, Counter[Levels]] = {}
    for row in grouped.agg(F.count("*").alias("n")).collect():
        places = tuple(row[rule] for rule in GRIDS)
        if row["chooses"] and row["quality"] in choosing:
            choosing[row["quality"]][places] += row["n"]
        elif not row["chooses"] and row["quality"] == 1:
            certifying.setdefault(row["stratum"], Counter())[places] += row["n"]
    path = choose_path(choosing[1], choosing[0])
    doubt = delta / (len(STRATA) + 1)
    cutoffs: dict[tuple[int, str], float] = {}
    for stratum, good in certifying.items():
        for setting in path:
            if not rejects_at_most(rejected(good, setting), good.total(), alpha, doubt):
                break
            for (rule, grid), used in zip(GRIDS.items(), setting, strict=True):
                if used:
                    cutoffs[stratum, rule] = grid[used - 1]
    return cutoffs


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """``doc_id``, ``stratum``, ``COUNTS``, ``base_failed``, ``rejected_by`` and ``kept`` of every row.

    A null or empty text has no words and fails the base rules; repeated rows
    are judged alike; an empty table gives no rows; without labels nothing is
    certified and only the base rules reject. Columns other than the three
    named are not read.
    """
    counts = stored(count_texts(docs, id_column, text_column, stratum_of(F.col(lang_column))))
    cutoffs = certified_cutoffs(counts, labels, alpha, delta)
    values = measures()
    hits = [
        F.when((F.col("stratum") == stratum) & (values[rule] > cutoff), F.lit(rule))
        for (stratum, rule), cutoff in sorted(cutoffs.items())
    ]
    reasons = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    judged = counts.withColumn("base_failed", base_failed()).withColumn("rejected_by", reasons)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
