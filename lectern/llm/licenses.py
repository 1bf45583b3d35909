"""License scan: an exact set-similarity join of text blocks with license templates.

A block matches a template when it contains at least ``threshold`` of the template's distinct words.
Words are ordered by how many documents hold them, the rarest first. With a threshold of t, a block
that matches must hold one of the first ``size - ceil(t * size) + 1`` words of the template in that
order (prefix filter); it must have enough words (length filter); and from the first common word on,
enough words must be left on both sides (positional filter). What passes is verified.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.llm.common import ascii_lower
from lectern.session import stage

# Characters that separate words; everything else (ASCII letters, digits, any other character) is part of one.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Opening sentences of public licenses, and the usual one-line notices: label, text.
NOTICES = [
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# The whole wording of short public licenses, label and text.
WHOLE_TEXTS = [
    ("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
]

THRESHOLD = 0.9

# Words of a block; the next one starts half a block later, so any passage of up to 48 words lies whole in one.
BLOCK_WORDS = 96


def passages(texts: list[tuple[str, str]], words: int = BLOCK_WORDS // 2) -> list[tuple[str, str]]:
    """Each text cut evenly into templates of at most so many words, so that none is a short rest that stands
    everywhere, and each lies whole in some block."""
    cut = []
    for label, text in texts:
        found = _plain_words(text)
        parts = -(-len(found) // words)
        edges = [i * len(found) // parts for i in range(parts + 1)] if parts else []
        cut += [(label, " ".join(found[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
    return cut


def words_of(text: Column) -> Column:
    """Words in order: runs of characters that are no separators, A-Z in lower case."""
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def _plain_words(text: str) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in lowered).split()


TEMPLATES = NOTICES + passages(WHOLE_TEXTS)


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def template_table(spark: SparkSession, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """template, label, words (distinct), size, need: one row per template with at least one word."""
    rows = []
    for i, (label, text) in enumerate(templates):
        words = sorted(set(_plain_words(text)))
        if words:
            need = max(1, -(-round(threshold * len(words) * 1_000_000) // 1_000_000))
            rows.append((i, label, words, len(words), need))
    return spark.createDataFrame(rows, "template int, label string, words array<string>, size int, need int")


def _starts(phrase: str) -> Column:
    """Word numbers at which the phrase starts in ``_words``."""
    parts = phrase.split()
    numbers = F.sequence(F.lit(0), F.size("_words") - F.lit(len(parts)))

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get("_words", i + k) == w for k, w in enumerate(parts)])

    # most texts hold no such word at all
    possible = (F.size("_words") >= len(parts)) & reduce(
        lambda a, b: a & b, [F.array_contains("_words", w) for w in parts]
    )
    return F.when(possible, F.filter(numbers, here)).otherwise(F.array().cast("array<int>"))


def phrase_places(docs: DataFrame, id_col: str, text: str, phrases: dict[str, str], vocabulary: list[str]) -> DataFrame:
    """Per row: words, places of the phrases, their labels, and the template words that it holds."""
    found = {f"_at{i}": _starts(p) for i, p in enumerate(phrases)}
    places = F.concat(*[F.col(c) for c in found]) if found else F.array().cast("array<int>")
    labels = [F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(found, phrases.values(), strict=True)]
    return (
        docs.select(F.col(id_col).alias("doc_id"), words_of(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
        .select(
            "doc_id",
            F.size("_words").cast("long").alias("n_words"),
            *[e.alias(c) for c, e in found.items()],
            F.array_intersect("_words", _literal(vocabulary)).alias("held"),
        )
        .withColumn("_places", places)
        .select(
            "doc_id",
            "n_words",
            F.size("_places").cast("long").alias("n_base"),
            F.array_min("_places").cast("long").alias("first_word"),
            F.array_max("_places").cast("long").alias("last_word"),
            F.array_distinct(F.array_compact(F.array(*labels))).cast("array<string>").alias("base"),
            "held",
        )
    )


def template_matches(
    docs: DataFrame,
    held: DataFrame,
    templates: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every block and template at or above the threshold: doc_id, block, template, label, containment.

    ``held``: a column of that name with the template words of each document, for the global order.
    """
    # one row per template word: the vocabulary of the templates is all that is counted
    counted = held.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("documents"))
    vocabulary = templates.select(F.explode("words").alias("word")).distinct()
    order = [
        row.word
        for row in vocabulary.join(counted, "word", "left")
        .orderBy(F.coalesce("documents", F.lit(0)), "word")
        .collect()
    ]
    ranks = {word: i for i, word in enumerate(order)}
    index = []
    for t in templates.collect():
        by_rank = sorted(t.words, key=ranks.__getitem__)
        for position, word in enumerate(by_rank[: t.size - t.need + 1]):
            index.append((word, position, t.template, t.label, t.words, t.size, t.need))
    spark = docs.sparkSession
    schema = "word string, position int, template int, label string, words array<string>, size int, need int"
    prefixes = spark.createDataFrame(index, schema)
    rare = _literal(sorted({row[0] for row in index}))
    step = block_words // 2
    last = F.greatest(F.lit(0), F.ceil((F.size("_words") - F.lit(block_words)) / F.lit(step)).cast("int"))
    blocks = (
        docs.select(F.col(id_col).alias("doc_id"), words_of(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
        .where(F.arrays_overlap("_words", rare))
        .select("doc_id", "_words", F.explode(F.sequence(F.lit(0), last)).alias("block"))
        .select("doc_id", "block", F.slice("_words", F.col("block") * step + 1, F.lit(block_words)).alias("_words"))
        .where(F.arrays_overlap("_words", rare))
        .select("doc_id", "block", F.array_distinct("_words").alias("_words"))
        .select(
            "doc_id",
            "block",
            F.size("_words").alias("_size"),
            F.filter(_literal(order), lambda w: F.array_contains("_words", w)).alias("_held"),
        )
    )
    held_words = blocks.select("doc_id", "block", "_size", "_held", F.posexplode("_held").alias("_at", "word"))
    enough = (
        (F.col("_size") >= F.col("need"))
        & (F.size("_held") - F.col("_at") + F.col("position") >= F.col("need"))
        & (F.col("size") - F.col("position") + F.col("_at") >= F.col("need"))
    )
    candidates = held_words.join(F.broadcast(prefixes), "word").where(enough)  # one row per prefix word
    common = F.size(F.array_intersect("_held", "words"))
    return (
        candidates.withColumn("_common", common)
        .where(F.col("_common") >= F.col("need"))
        .select("doc_id", "block", "template", "label", (F.col("_common") / F.col("size")).alias("containment"))
        .distinct()
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: places of license phrases, and labels of the templates its blocks contain.

    doc_id, n_words, n_base (places where a phrase's words stand one after the other), first_word and
    last_word (smallest and largest start, else null), base_labels, labels (with those of matching
    templates), score: 1 where a phrase stands, else the largest containment of a template, else 0.

    A null text is empty and has no labels. Rows that repeat an id each give a row; a template found in
    one of them counts for all. An empty table gives no rows. Further columns are ignored.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates, threshold)
    vocabulary = sorted({w for _, t in templates for w in _plain_words(t)})
    per_row = stage(phrase_places(docs, id_col, text, phrases, vocabulary), "license-phrases")
    matches = template_matches(docs, per_row, known, id_col, text, block_words)
    found = matches.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best")
    )
    nothing = F.array().cast("array<string>")
    joined = per_row.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    labels = F.array_union("base", F.coalesce("_labels", nothing))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0)))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"),
    )
