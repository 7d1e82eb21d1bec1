"""Operator 7, license scan by diagonal voting, in DataFrame functions only.

Every rolling k-gram of words of every text is joined, by hash and then by its words, to the places where
the templates have that k-gram: pairs for base phrases and single sentences, four words for whole license texts
(a long text holds pairs such as "of the" that stand everywhere). Hits of one template vote for their diagonal
(place in the text less place in the template). Base phrases hold at a place if all their pairs vote for one
diagonal. For the other templates neighbouring diagonals, up to 3 apart, are merged (words added or left out),
and a merged span is verified: it must show at least 70 % of the template's k-grams within one and a half times
the template's length.

Grams that no template has would find no partner in the join; they are left out before they become rows, by the
set of the templates' pairs. Texts are split once: ids, word counts and the grams left are staged.

The templates are a parameter, whose number of grams is checked before they are broadcast.

Defined cases: a null or empty text has no words and no places. Rows repeating doc_id and text are
one document listed twice and get the same result; extra columns are left behind. No rows give no rows.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keyed, stage
from .quality import let

#: White space and ASCII other than letters and digits; applied to lower-cased text.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Well-known sentences of license texts and notices.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("all rights reserved", "proprietary"),
)
#: Whole license texts and notices, without their copyright lines (fixed values).
TEXTS = (
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "mit"),
    ("""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS
SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""", "bsd"),
    ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", "isc"),
    ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.""", "apache"),
    ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program.""", "gpl"),
    ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
or non-commercial, and by any means.""", "unlicense"),
)
GAP, SHARE_PERCENT, LENGTH_PERCENT, MOST_GRAMS = 3, 70, 150, 10_000
#: Words of a gram: of phrases and sentences, of whole texts.
SHORT, LONG = 2, 4


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), NOT_WORD), "")


def numbered(phrases=PHRASES, templates=TEMPLATES, texts=TEXTS) -> list[tuple[int, list[str], str, bool, int]]:
    """(number, words, label, base, words of a gram) of each template."""
    kinds = [(phrases, True, SHORT), (templates, False, SHORT), (texts, False, LONG)]
    rows = [([w for w in re.split(NOT_WORD, text.lower()) if w], label, base, k) for group, base, k in kinds for text, label in group]
    for own, *_, k in rows:
        if len(own) < k:
            raise ValueError(f"a template needs {k} words: {own!r}")
    return [(number, *row) for number, row in enumerate(rows)]


def template_grams(spark, templates) -> DataFrame:
    """(template_gram, hash, template, label, base, k, at, grams), one row for each gram of each template."""
    rows = [(" ".join(own[i:i + k]), number, label, base, k, i, len(own) - k + 1) for number, own, label, base, k in templates for i in range(len(own) - k + 1)]
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"{len(rows)} grams of the templates; at most {MOST_GRAMS} are broadcast")
    grams = spark.createDataFrame(rows, "template_gram string, template int, label string, base boolean, k int, at int, grams int")
    return grams.withColumn("hash", F.xxhash64("template_gram"))


def _grams(words: Column, templates) -> Column:
    """(place, gram) of each gram of the words that a template may have."""
    pairs_of = lambda k: sorted({" ".join(own[i:i + 2]) for _, own, _, _, n in templates if n == k for i in range(len(own) - 1)})
    short, long = pairs_of(SHORT), pairs_of(LONG)
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)))
    none = F.array().cast("array<struct<place:int,gram:string>>")

    def of_pairs(p: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(p) - 1)
        two = F.filter(every, lambda i: F.get(p, i).isin(short)) if short else F.array().cast("array<int>")
        four = F.filter(every, lambda i: F.get(p, i).isin(long) & F.get(p, i + 2).isin(long)) if long else F.array().cast("array<int>")
        return F.concat(F.transform(two, lambda i: F.struct(i.alias("place"), F.get(p, i).alias("gram"))),
                        F.transform(four, lambda i: F.struct(i.alias("place"), F.concat(F.get(p, i), F.lit(" "), F.get(p, i + 2)).alias("gram"))))
    return F.when(F.size(words) >= 2, let(pairs, of_pairs)).otherwise(none)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row."""
    own = keyed(docs)
    all_templates = numbered(phrases, templates, texts)
    judged = let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _grams(w, all_templates).alias("grams")))
    split = stage(own.select("doc_id", "text_key", judged.alias("own")).select("doc_id", "text_key", "own.n_words", "own.grams"), "grams")
    places = split.where(F.size("grams") > 0).select("doc_id", "text_key", F.inline("grams"))
    known = template_grams(docs.sparkSession, all_templates)
    hits = places.join(F.broadcast(known), (F.xxhash64("gram") == F.col("hash")) & (F.col("gram") == F.col("template_gram")))
    diagonals = hits.groupBy("doc_id", "text_key", "template", "label", "base", "k", "grams", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("seen"), F.min("place").alias("low"), F.max("place").alias("high"))
    # neighbouring diagonals of a template become one group; base phrases stay by themselves
    line = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.col("base") | (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line), F.lit(GAP + 1)) > GAP)
    grouped = diagonals.withColumn("new", F.when(apart, 1).otherwise(0)).withColumn("group", F.sum("new").over(line))
    merged = grouped.groupBy("doc_id", "text_key", "template", "group").agg(
        F.first("label").alias("label"), F.first("base").alias("base"), F.first("k").alias("k"), F.first("grams").alias("grams"), F.min("diagonal").alias("start"),
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("votes"), (F.max("high") - F.min("low") + F.first("k")).alias("span"))
    good = F.when(F.col("base"), F.col("votes") == F.col("grams")).otherwise(
        (100 * F.col("votes") >= SHARE_PERCENT * F.col("grams")) & (100 * F.col("span") <= LENGTH_PERCENT * (F.col("grams") + F.col("k") - 1)))
    base = F.col("base") & F.col("good")
    found = merged.withColumn("good", good).groupBy("doc_id", "text_key").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("good"), F.col("label")))), ",").alias("labels"),
        F.max(F.when(F.col("good"), F.col("votes") / F.col("grams"))).alias("score"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    counted = split.select("doc_id", "text_key", "n_words")
    out = counted.join(found, counted["doc_id"].eqNullSafe(found["_id"]) & (counted["text_key"] == found["_key"]), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"))
