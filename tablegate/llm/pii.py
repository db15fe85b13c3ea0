"""Personal data by weak supervision, in DataFrame operations only.

Candidate spans get votes from labelers: exact patterns, loose patterns,
gazetteers, the words around them, their length. Expectation-maximisation
over the counts of equal vote patterns estimates how reliable each labeler
is; its posteriors train a logistic span classifier, which decides as one SQL
expression. Spans of the exact patterns always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tablegate.functions.bind import bind
from tablegate.llm.scans import count_below, part_of, pieces_of, running_max, running_sum

# The kinds, in the order in which spans of one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("number", "secret", "address")

# The patterns. Runs are matched possessively and from their
# first character on (or where the last match ended), which finds the same
# spans as the plain patterns, in linear time.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"[0-9](?:[\x20-]?[0-9])++",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{24,}+",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++ ?[\[(]dot[\])] ?[A-Za-z]{2,}+",
}
# A text without this cannot hold the pattern; a cheap test before the regex.
NEEDS = {
    "email": ("contains", "@"),
    "ip": ("rlike", r"[0-9]\.[0-9]++\."),
    "card": ("rlike", r"(?:[0-9][\x20-]?){11}[0-9]"),
    "phone": ("rlike", r"\+[0-9]"),
    "number": ("rlike", r"(?:[0-9][\x20-]?){6}[0-9]"),
    "secret": ("rlike", r"(?<![A-Za-z0-9])[A-Za-z0-9]{24}"),
    "address": ("rlike", r"[\[(]at[\])]"),
}
# Gazetteers and context words, in lower case.
CONTEXT = (
    "account", "api", "call", "card", "contact", "credit", "email", "fax", "iban", "id", "key",
    "konto", "mail", "mobile", "number", "pass", "password", "passwort", "phone", "secret",
    "ssn", "tel", "telefon", "token", "visa",
)
DOMAINS = ("com", "net", "org", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6(?:011|5))"
WINDOW = 24


@dataclass(frozen=True)
class Labeler:
    """Weights of one labeler's vote under the two classes, as estimated."""

    name: str
    real: dict[int, float]
    other: dict[int, float]


def digits_of(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.filter(reverse, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, span: Column) -> Column:
    """The check that a match of a base pattern must pass."""
    digits = digits_of(span)
    if kind == "ip":
        low = F.transform(F.split(span, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
        return F.forall(low, lambda ok: ok)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def found(text: Column, kind: str) -> Column:
    """All matches: array of (kind, start, end, span, before), code points, end exclusive.

    Splitting at a pattern gives the gaps, extracting it the matches; their
    running lengths are positions. Each is made once per text, and only for
    texts that can hold the pattern; the time is linear in the matches.
    """
    pattern = PATTERNS[kind]

    def place(matches: Column, gaps: Column) -> Column:
        steps = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return bind(
            running_sum(steps),
            lambda ends: F.transform(
                matches,
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"),
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.get(ends, i).alias("end"),
                    m.alias("span"),
                    F.lower(F.right(F.get(gaps, i), F.lit(WINDOW))).alias("before"),
                ),
            ),
        )

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = bind(matches, lambda ms: bind(F.split(text, pattern, -1), lambda gaps: place(ms, gaps)))
    how, what = NEEDS[kind]
    possible = text.contains(what) if how == "contains" else text.rlike(what)
    return F.when(possible, spans).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<kind:string,start:int,end:int,span:string,before:string>>"
LABELERS = ("exact", "shape", "gazetteer", "context", "length")


def base_spans(text: Column) -> Column:
    """Spans of the four base patterns that pass their checks."""

    def passing(kind: str) -> Column:
        return F.filter(found(text, kind), lambda span: valid(kind, span["span"]))

    return F.concat(*(passing(kind) for kind in BASE_KINDS))


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others: of those that start before its end, none may reach past its start."""

    def keep(ordered: Column) -> Column:
        starts = F.transform(ordered, lambda b: b["start"])
        reach = running_max(F.transform(ordered, lambda b: b["end"]))
        return bind(starts, lambda s: bind(reach, lambda r: F.filter(spans, lambda x: ~_touched(x, s, r))))

    pairs = F.transform(others, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    return bind(F.array_sort(pairs), keep)


def _touched(span: Column, starts: Column, reach: Column) -> Column:
    before = count_below(starts, span["end"])
    return F.coalesce(F.get(reach, before - 1) > span["start"], F.lit(False))


def votes(span: Column) -> Column:
    """One vote of each labeler on a span: 1 personal, -1 not, 0 no opinion."""
    kind, value, before = span["kind"], span["span"], span["before"]
    digits = digits_of(value)
    exact = F.lit(False)
    for k in BASE_KINDS:
        exact = exact | ((kind == k) & valid(k, value))
    cards = kind.isin("card", "number")
    shape = (
        F.when(kind.isin("email", "phone", "address"), 1)
        .when(kind == "ip", F.when(value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), 1).otherwise(-1))
        .when(cards, F.when(value.rlike(r"^[0-9]{15,16}$|^(?:[0-9]{4}[ -]){3}[0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), 1).otherwise(-1))
        .otherwise(F.when(value.rlike(r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), 1)
                   .when(value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]"), 1).otherwise(-1))
    )
    domain = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    gazetteer = (
        F.when(kind.isin("email", "address"), F.when(domain.isin(*DOMAINS), 1).otherwise(0))
        .when(cards, F.when(digits.rlike(ISSUERS), 1).otherwise(-1))
        .when(kind == "phone", F.when(digits.rlike("^(?:1|33|34|39|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-58])"), 1).otherwise(-1))
        .otherwise(0)
    )
    words = r"(?:" + "|".join(CONTEXT) + r")[\p{L}]{0,3}\W{0,6}$"
    context = F.when(before.rlike(words), 1).otherwise(0)
    n = F.length(digits)
    length = (
        F.when(kind == "email", F.when(F.length(value).between(6, 64), 1).otherwise(-1))
        .when(kind == "address", F.when(F.length(value).between(8, 96), 1).otherwise(-1))
        .when(kind == "phone", F.when(n.between(9, 15), 1).otherwise(-1))
        .when(cards, F.when(n.between(15, 16), 1).when((n == 9) & value.contains("-"), 1).otherwise(-1))
        .when(kind == "secret", F.when(F.length(value).isin(32, 40, 64), 1).otherwise(0))
        .otherwise(0)
    )
    each = (F.when(exact, 1).otherwise(0), shape, gazetteer, context, length)
    return F.struct(*(v.cast("int").alias(name) for name, v in zip(LABELERS, each, strict=True)))


def with_candidates(docs: DataFrame, text_column: str) -> DataFrame:
    """Two columns more: base spans, and spans of the wider patterns that overlap none of them.

    Each is computed once a row, and only for texts that can hold a span.
    """
    text = F.col(text_column)
    may_hold = F.coalesce(text.rlike(r"[0-9@]|[\[(]at[\])]"), F.lit(False))
    none = F.array().cast(SPANS)
    wide = F.concat(*(found(text, kind) for kind in EXTRA_KINDS))
    staged = docs.withColumn(BASE, F.when(may_hold, base_spans(text)).otherwise(none))
    staged = staged.withColumn(WIDE, F.when(may_hold, wide).otherwise(none))
    apart = apart_from(F.col(WIDE), F.col(BASE))
    return staged.withColumn(WIDE, F.when(F.size(WIDE) > 0, apart).otherwise(F.col(WIDE)))


BASE, WIDE = "__pii_base", "__pii_wide"


def estimate(patterns: list[Row], rounds: int = 40) -> tuple[float, list[Labeler], dict[tuple, float]]:
    """Two-class expectation-maximisation over counted vote patterns.

    There are at most 3^5 patterns, whatever the corpus holds. Returns the
    share of real spans, each labeler's vote probabilities under both classes,
    and each pattern's posterior. An exact match is known to be real, which
    also keeps the classes from changing places.
    """
    counts = {tuple(row[name] for name in LABELERS): float(row["n"]) for row in patterns}
    posterior = {p: 0.98 if p[0] == 1 else 1 / (1 + math.exp(-1.5 * sum(p))) for p in counts}
    prior, tables = 0.5, []
    for _ in range(rounds):
        real = {p: counts[p] * posterior[p] for p in counts}
        other = {p: counts[p] - real[p] for p in counts}
        total, yes = sum(counts.values()), sum(real.values())
        prior = min(max((yes + 1) / (total + 2), 0.02), 0.98)
        tables = [
            Labeler(name, _share(real, i), _share(other, i))
            for i, name in enumerate(LABELERS)
        ]
        posterior = {p: 0.98 if p[0] == 1 else _posterior(p, prior, tables) for p in counts}
    return prior, tables, posterior


def _share(mass: dict[tuple, float], place: int) -> dict[int, float]:
    total = sum(mass.values()) + 3
    return {v: (sum(m for p, m in mass.items() if p[place] == v) + 1) / total for v in (-1, 0, 1)}


def _posterior(pattern: tuple, prior: float, tables: list[Labeler]) -> float:
    odds = math.log(prior / (1 - prior))
    odds += sum(math.log(t.real[v] / t.other[v]) for t, v in zip(tables, pattern, strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def train(posterior: dict[tuple, float], counts: dict[tuple, float], steps: int = 400, rate: float = 0.5) -> list[float]:
    """Logistic weights (bias first) that fit the posteriors, each pattern weighted by its count.

    Counts enter by their logarithm, so that one frequent pattern does not
    drown the rest; a small ridge keeps separable data finite.
    """
    features = {p: (1.0, *(float(v == s) for v in p for s in (1, -1))) for p in posterior}
    weights = [0.0] * (1 + 2 * len(LABELERS))
    mass = {p: math.log1p(counts[p]) for p in posterior}
    total = sum(mass.values()) or 1.0
    for _ in range(steps):
        slope = [0.001 * w for w in weights]
        for p, x in features.items():
            miss = 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x, strict=True)))) - posterior[p]
            for k, v in enumerate(x):
                slope[k] += mass[p] * miss * v / total
        weights = [w - rate * 4 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def fit_labelers(docs: DataFrame, text_column: str = "text") -> list[float]:
    """Classifier weights from the votes on every candidate of all texts."""
    both = with_candidates(docs.select(text_column), text_column)
    spans = both.select(F.explode(F.concat(BASE, WIDE)).alias("span"))
    counted = spans.select(votes(F.col("span")).alias("v")).select("v.*").groupBy(*LABELERS).agg(F.count("*").alias("n"))
    patterns = counted.collect()
    if not patterns:
        return [-1.0] + [0.0] * (2 * len(LABELERS))
    _, _, posterior = estimate(patterns)
    counts = {tuple(row[name] for name in LABELERS): float(row["n"]) for row in patterns}
    return train(posterior, counts)


def accepted(span: Column, weights: list[float]) -> Column:
    """Whether the trained classifier takes the span."""
    vote = votes(span)
    odds = F.lit(weights[0])
    for i, name in enumerate(LABELERS):
        yes, no = weights[1 + 2 * i], weights[2 + 2 * i]
        odds = odds + F.when(vote[name] == 1, yes).when(vote[name] == -1, no).otherwise(0.0)
    return odds > 0


def marked(span: Column) -> Column:
    """A span as it is returned; its field order is the order of spans."""
    rank = F.lit(len(BASE_KINDS + EXTRA_KINDS))
    for place, kind in enumerate(BASE_KINDS + EXTRA_KINDS):
        rank = F.when(span["kind"] == kind, place).otherwise(rank)
    return F.struct(
        span["start"].alias("start"), rank.alias("rank"), span["end"].alias("end"), span["kind"].alias("kind")
    )


def find_personal(docs: DataFrame, text_column: str = "text", name: str = "pii") -> DataFrame:
    """Each row with ``pii`` (or another name): its spans (start, rank, end, kind), ordered.

    Positions are code points, ends exclusive. A null or empty text has no
    spans, an empty table no rows; repeated rows are treated alike; other
    columns pass through, one of that name is replaced. The votes are
    counted over all texts first, then a second scan decides. Only counts of
    vote patterns, at most 3^5, reach the driver.
    """
    weights = fit_labelers(docs, text_column)
    both = with_candidates(docs.drop(name), text_column)
    kept = F.concat(F.col(BASE), F.filter(WIDE, lambda span: accepted(span, weights)))
    return both.withColumn(name, F.array_sort(F.transform(kept, marked))).drop(BASE, WIDE)


def redact(docs: DataFrame, text_column: str = "text", name: str = "pii") -> DataFrame:
    """Replace every span by its kind in brackets; overlapping spans become one. Other texts stay as they are."""
    text, spans = F.col(text_column), F.col(name)

    def fill(reach: Column, pieces: Column) -> Column:
        def replaced(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(reach, i - 1), F.lit(0))
            label = F.concat(F.lit("["), s["kind"], F.lit("]"))
            return F.when(s["start"] >= before, F.concat(part_of(pieces, before, s["start"]), label)).otherwise("")

        rest = part_of(pieces, F.get(reach, F.size(reach) - 1), F.length(text))
        return F.concat(F.array_join(F.transform(spans, replaced), ""), rest)

    reach = running_max(F.transform(spans, lambda s: s["end"]))
    clean = bind(reach, lambda r: bind(pieces_of(text), lambda pieces: fill(r, pieces)))
    return docs.withColumn(text_column, F.when(F.size(spans) > 0, clean).otherwise(text)).drop(name)
