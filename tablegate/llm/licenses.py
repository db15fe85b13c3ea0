"""License scans by diagonal voting.

Rolling word grams of a text are joined to the positions they have in license
templates. A hit at place p of the text and place t of a template votes for
the diagonal p - t. Words that a copy adds or leaves out move its later hits
to a neighbouring diagonal, so neighbours that continue each other are merged.
A merged run is taken if the template's words it really holds are enough.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegate.llm.sizes import BROADCAST_ROWS
from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches, rows_within, text_bytes

PHRASE_GRAM = 2  # a phrase needs all its words in order, on one diagonal
TEXT_GRAM = 5
SHARE = 0.8  # of a text template's words
SHIFT = 8  # diagonals so near may belong to one copy
GAP = 12  # words of the text between two parts of one copy

# A word is a run of these characters, A-Z in lower case.
_CLEAN = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_CLEAN).split()


@dataclass(frozen=True)
class Template:
    """A phrase, all of whose words must stand together, or (``whole``) a text that may be changed a little."""

    label: str
    text: str
    base: bool = False
    whole: bool = False

    @property
    def words(self) -> list[bytes]:
        return words_of(self.text.encode())

    @property
    def gram(self) -> int:
        return TEXT_GRAM if self.whole else PHRASE_GRAM


# The base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)
# More phrases, and the wording of common notices.
MORE = (
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution"),
    Template("cc0", "cc0 1 0"),
    Template("mpl", "mozilla public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("reserved", "all rights reserved"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        whole=True,
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied",
        whole=True,
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        whole=True,
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer",
        whole=True,
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        whole=True,
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
        whole=True,
    ),
    Template(
        "unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
        whole=True,
    ),
)
TEMPLATES = (*BASE, *MORE)


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``template``, ``at`` and ``gram`` of every rolling gram of every template, with its ``hash``."""
    rows = []
    for number, template in enumerate(templates):
        words = template.words
        if len(words) < template.gram:
            raise ValueError(f"template {template.label!r} has fewer than {template.gram} words")
        for at in range(len(words) - template.gram + 1):
            rows.append((number, at, b" ".join(words[at : at + template.gram]).decode()))
    grams = spark.createDataFrame(rows, "template int, at int, gram string").withColumn("hash", F.xxhash64("gram"))
    return F.broadcast(grams) if len(rows) <= BROADCAST_ROWS else grams


def rolling_grams(docs: DataFrame, templates: Sequence[Template], id_column: str, text_column: str) -> DataFrame:
    """``row``, ``doc_id``, ``n_words`` and the rolling grams (``places``, ``grams``) of every text.

    A gram with a word that no template of its width holds can join nothing
    and is not made.
    """
    vocabulary = {
        width: frozenset(w for t in templates if t.gram == width for w in t.words) for width in (PHRASE_GRAM, TEXT_GRAM)
    }
    frame = text_bytes(
        docs, text_column, F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id")
    )
    schema = pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("places", pa.list_(pa.int32())), ("grams", pa.list_(pa.string())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row, doc_id, raw in rows_within(batches):
                words = words_of(raw)
                places, grams = [], []
                for width, known in vocabulary.items():
                    run = 0
                    for at in [i for i, word in enumerate(words) if word in known]:
                        run = run + 1 if run and at == last + 1 else 1
                        last = at
                        if run >= width:
                            places.append(at - width + 1)
                            grams.append(b" ".join(words[at - width + 1 : at + 1]).decode("utf-8", "replace"))
                yield row, doc_id, len(words), places, grams

        yield from in_batches(rows(), schema, weigh=lambda r: 64 * len(r[3]) + 32)

    return frame.mapInArrow(cut, "row long, doc_id long, n_words long, places array<int>, grams array<string>")


def diagonals(cut: DataFrame, grams: DataFrame) -> DataFrame:
    """One row per text, template and diagonal with a vote: the template places that voted for it.

    A place votes once for a diagonal, so ``votes`` is no longer than the template.
    """
    pairs = F.explode(F.arrays_zip(F.col("places").alias("place"), F.col("grams").alias("gram"))).alias("said")
    said = cut.where(F.size("grams") > 0).select("row", pairs).select("row", "said.place", "said.gram")
    # equal hashes choose, equal words verify each vote
    hits = said.withColumn("hash", F.xxhash64("gram")).join(grams, ["hash", "gram"])
    return hits.groupBy("row", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.collect_list("at").alias("votes")
    )


def merged(found: DataFrame, width: Column) -> DataFrame:
    """Neighbouring diagonals that continue each other as one run: its first and last place, and all votes."""
    by = Window.partitionBy("row", "template")
    near = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by.orderBy("diagonal")) > SHIFT, F.lit(True))
    bands = found.withColumn("__new", near.cast("int")).withColumn(
        "band", F.sum("__new").over(by.orderBy("diagonal").rowsBetween(Window.unboundedPreceding, 0))
    )
    inside = Window.partitionBy("row", "template", "band").orderBy("first", "diagonal")
    reached = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("first") - (reached + width) > GAP, F.lit(True))
    runs = bands.withColumn("__new", apart.cast("int")).withColumn(
        "run", F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    return runs.groupBy("row", "template", "band", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
    )


def _each(templates: Sequence[Template], value) -> Column:
    """A property of the row's template."""
    return F.element_at(F.array(*(F.lit(value(t)) for t in templates)), F.col("template") + 1)


def find_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_words`` and ``matches`` of every row: (start, end, label, base, share), words from 0, end exclusive.

    A phrase matches where all its words stand together. A whole text
    matches where runs of its words hold ``SHARE`` of it or more; ``share`` is
    what they hold (1 for a phrase). Matches are ordered by start, and may
    overlap. A null or empty text has no words and no matches; repeated rows
    are treated alike; an empty table gives no rows; other columns are not
    read. Templates are a parameter and small; the grams of the texts meet
    them in one join, and everything after it grows with the hits alone.
    """
    spark = docs.sparkSession
    cut = stored(rolling_grams(docs, templates, id_column, text_column))
    voted = stored(diagonals(cut, template_grams(spark, templates)))
    size, width = _each(templates, lambda t: len(t.words)), _each(templates, lambda t: t.gram)
    whole = _each(templates, lambda t: t.whole)
    phrases = voted.where(~whole & (F.size("votes") == size - width + 1)).select(
        "row", "template", "first", "last", F.lit(1.0).alias("share")
    )
    # words that the run's grams cover, each counted once
    covered = F.size(F.array_distinct(F.flatten(F.transform("votes", lambda t: F.sequence(t, t + width - 1)))))
    texts = merged(voted.where(whole), width).withColumn("share", covered / size).where(F.col("share") >= SHARE)
    spans = phrases.unionByName(texts.select(*phrases.columns))
    match = F.struct(
        F.col("first").alias("start"), (F.col("last") + width).alias("end"),
        _each(templates, lambda t: t.label).alias("label"), _each(templates, lambda t: t.base).alias("base"), "share",
    )
    by_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(match)).alias("matches"))
    kind = by_row.schema["matches"].dataType
    return cut.select("row", "doc_id", "n_words").join(by_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("matches", F.array().cast(kind)).alias("matches")
    )
