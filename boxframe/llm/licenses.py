"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-gram hashes of every text are joined to the k-gram
positions of the templates (a fixed, bounded table, broadcast). A match of
text position p with template position q votes for the diagonal p - q. Votes
are summed per (row, template, diagonal); neighbouring diagonals (words
inserted or left out) are merged into spans, and a span is verified by the
share of distinct template positions it covers and its length. Base phrases
are templates of their own with k = 2: an occurrence is a diagonal on which
every k-gram of the phrase votes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from boxframe.llm.common import cut_lineage

#: The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Well-known license notices and their labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
               "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
               "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
               "permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            "GNU General Public License for more details."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
            "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
             "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
             "following restrictions:"),
)
Templates = Sequence[tuple[str, str]]
#: The bound of a template table: rows, and letters of all templates. Its k-grams are broadcast.
MAX_TEMPLATES = 5_000
MAX_LETTERS = 8_000_000

#: Lower-cased words: digits, a-z and everything beyond ASCII.
LICENSE_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Scan:
    """Parameters of the vote: k-gram size of the notices, diagonal drift within one span, least share of a template."""

    k: int = 3
    drift: int = 4
    min_share: float = 0.6


def template_words(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(LICENSE_WORD, lowered)


def read_templates(table: DataFrame) -> list[tuple[str, str]]:
    """The templates of a table (label, text): licence texts of any length, several a label if need be, in a fixed order.

    The table must keep ``MAX_TEMPLATES`` and ``MAX_LETTERS``, which is checked
    before it is read. Rows without a label or text, and repeated rows, count for nothing.
    """
    kept = table.select(F.col("label").cast("string"), F.col("text").cast("string")).where("label is not null and text is not null").distinct()
    n, letters = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text") + F.length("label")), F.lit(0))).first()
    if n > MAX_TEMPLATES or letters > MAX_LETTERS:
        raise ValueError(f"{n} templates of {letters} letters; at most {MAX_TEMPLATES} of {MAX_LETTERS}")
    return sorted((r.label, r.text) for r in kept.collect())


def template_grams(spark, k: int, templates: Templates = TEMPLATES) -> DataFrame:
    """kind ('b' phrase, 't' notice), template number, position, its k-gram's hash and the template's k-gram count.

    Hashes are made by the same Spark expressions as the texts'. Templates of fewer than ``k`` words have none.
    """
    rows = [("b", n, template_words(p), 2) for n, (p, _) in enumerate(PHRASES)]
    rows += [("t", n, template_words(t), k) for n, (_, t) in enumerate(templates)]
    raw = spark.createDataFrame(rows, "kind string, tmpl int, words array<string>, k int")
    hashed = raw.withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
    grams = F.when(F.col("kind") == "b", gram_hashes("wh", 2)).otherwise(gram_hashes("wh", k))
    return hashed.withColumn("n_grams", F.size(grams)).select(
        "kind", "tmpl", "n_grams", F.posexplode(grams).alias("q", "gram"))


def gram_hashes(wh: str, k: int):
    """Hashes of all rolling k-grams of an array of word hashes; the gram size seeds the hash."""
    a = F.col(wh)
    return F.when(F.size(a) >= k, F.transform(
        F.sequence(F.lit(0), F.size(a) - k), lambda i: F.xxhash64(F.lit(k), *[a[i + j] for j in range(k)]))).otherwise(
        F.array().cast("array<bigint>"))


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scan: Scan = Scan(), templates: Templates = TEMPLATES) -> DataFrame:
    """Votes per (row, template, diagonal), plus one row of kind 'd' per input row carrying its word count.

    The row key ``__row`` keeps repeated rows and NULL ids apart.
    """
    # The Kelvin sign is the one letter beyond ASCII that Unicode lower-cases into ASCII; kra keeps it a foreign letter.
    text = F.lower(F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("K"), F.lit("ĸ")))
    words = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col), F.transform(
        F.regexp_extract_all(text, F.lit(f"({LICENSE_WORD})"), F.lit(1)), lambda w: F.xxhash64(w)).alias("__wh"))
    # One generator over both gram sizes; position -1 is the row itself.
    grams = words.select("__row", id_col, F.size("__wh").alias("n_words"), F.explode(F.concat(
        F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).cast("bigint").alias("gram"))),
        F.transform(gram_hashes("__wh", 2), lambda h, p: F.struct(p.alias("p"), h.alias("gram"))),
        F.transform(gram_hashes("__wh", scan.k), lambda h, p: F.struct(p.alias("p"), h.alias("gram"))),
    )).alias("g")).select("__row", id_col, "n_words", "g.p", "g.gram")
    own = docs.sparkSession.createDataFrame([("d", -1, 0, -1, 0)], "kind string, tmpl int, n_grams int, q int, gram bigint")
    table = template_grams(docs.sparkSession, scan.k, templates).select(own.columns).unionByName(own)
    hit = grams.join(F.broadcast(table), "gram").filter((F.col("kind") == "d") == (F.col("p") == -1))
    return hit.groupBy("__row", id_col, "n_words", "kind", "tmpl", "n_grams", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("p").alias("first_p"), F.max("p").alias("last_p"),
        F.collect_set("q").alias("covered"))


def spans(voted: DataFrame, id_col: str = "doc_id", scan: Scan = Scan()) -> DataFrame:
    """Verified spans: row, id, template kind and number, first and last word, share of the template covered.

    A phrase's diagonal is a span if all its k-grams voted. A notice's
    diagonals are merged in three ways, and every merged span counts that
    covers ``min_share`` of the template's k-grams and is no longer than the
    template with its missing part and drift (spans of a notice may overlap):
    all diagonals within ``drift`` of one; chains of diagonals in their order;
    chains in the order of their first words, where the next begins no further
    than ``drift`` beyond the words seen so far. A trigram that a template
    repeats makes stray diagonals far from the notice's own; the first two ways
    don't see them, whatever words stand between.
    """
    keys = ["__row", id_col, "n_words", "kind", "tmpl", "n_grams"]
    phrase = voted.filter((F.col("kind") == "b") & (F.col("votes") == F.col("n_grams"))).select(
        *keys, F.col("first_p").alias("first_word"), (F.col("last_p") + 1).alias("last_word"), F.lit(1.0).alias("share"))
    same = Window.partitionBy("__row", "kind", "tmpl")
    w, by_diagonal = same.orderBy("first_p", "diagonal"), same.orderBy("diagonal")
    near = by_diagonal.rangeBetween(0, scan.drift)
    notice = voted.filter(F.col("kind") == "t")
    seen = F.max("last_p").over(w.rowsBetween(Window.unboundedPreceding, -1))
    far = {x: F.abs(F.col("diagonal") - F.lag("diagonal").over(x)) > scan.drift for x in (w, by_diagonal)}
    apart = far[w] | (F.col("first_p") > seen + scan.k + scan.drift)
    begun = notice.withColumns({"__new": F.coalesce(apart, F.lit(True)).cast("int"), "__own": F.coalesce(far[by_diagonal], F.lit(True)).cast("int")})

    def covered(parts: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(parts)))

    def chains(new: str, order: WindowSpec) -> DataFrame:
        return begun.withColumn("__span", F.sum(new).over(order)).groupBy(*keys, "__span").agg(
            F.min("first_p").alias("first_word"), (F.max("last_p") + scan.k - 1).alias("last_word"),
            covered(F.collect_list("covered")).alias("__covered")).drop("__span")

    around = notice.select(
        *keys, F.min("first_p").over(near).alias("first_word"), (F.max("last_p").over(near) + scan.k - 1).alias("last_word"),
        covered(F.collect_list("covered").over(near)).alias("__covered"))
    merged = chains("__new", w).unionByName(chains("__own", by_diagonal)).unionByName(around)
    verified = merged.withColumn("share", F.col("__covered") / F.col("n_grams")).filter(
        (F.col("share") >= scan.min_share)
        & (F.col("last_word") - F.col("first_word") + 1 <= 1.5 * (F.col("n_grams") + scan.k - 1) + scan.drift))
    return phrase.unionByName(verified.select(*keys, "first_word", "last_word", "share").distinct())


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scan: Scan = Scan(),
                  templates: Templates | DataFrame = TEMPLATES) -> DataFrame:
    """One row per input row: words, base places and labels, all labels, score.

    ``templates`` are (label, text) pairs, or a table of them (see
    ``read_templates``), whole licence texts for instance; without any, base phrases alone give labels.

    NULL and empty texts have no words and no labels (empty strings, score 0);
    repeated rows give repeated results. The score is the largest covered share
    of a template (1 for a base phrase).
    """
    if isinstance(templates, DataFrame):
        templates = read_templates(templates)
    voted = cut_lineage(votes(docs, id_col, text_col, scan, templates), "votes")  # read three times below, and small
    own = voted.filter(F.col("kind") == "d").select(
        "__row", id_col, "n_words", F.lit("d").alias("kind"), F.lit(-1).alias("tmpl"),
        F.lit(None).cast("int").alias("first_word"), F.lit(0.0).alias("share"))
    found = spans(voted, id_col, scan).select("__row", id_col, "n_words", "kind", "tmpl", "first_word", "share")
    names = [F.array(*[F.lit(x) for x in labels]).cast("array<string>") for labels in ([x for _, x in PHRASES], [x for x, _ in templates])]
    base, more = F.col("kind") == "b", F.col("kind") == "t"
    label = F.when(base, F.get(names[0], F.col("tmpl"))).when(more, F.get(names[1], F.col("tmpl")))
    return own.unionByName(found).withColumn("label", label).groupBy("__row", id_col, "n_words").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score")).drop("__row").withColumn("n_words", F.col("n_words").cast("long"))
