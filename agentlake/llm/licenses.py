"""License scan by diagonal voting, all in DataFrame operations.

Every rolling k-gram of a document's words is hashed and joined to the positions it has in license templates. A match at
word ``pos`` of the document and ``tpos`` of the template votes for the diagonal ``pos - tpos``; neighbouring diagonals
are merged, as a word put in or left out moves the rest of a license by one; a merged diagonal becomes a label if enough
of the template's k-grams stand on it. Matches are verified word by word, so equal hashes of unequal words do not count.

Wordings of different labels that share so many k-grams that one would count as the other are rivals. A span of such a
wording needs the words that tell it from each rival, and of overlapping spans of rivals the best covered one stays.

The templates are a fixed list of a few kilobytes; that is what is broadcast, whatever the size of the corpus.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.rows import texts

#: Phrase -> label of the base rule. Fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of a k-gram; diagonals no further apart are one; share of a template's k-grams that makes a label.
GRAM, SLACK, COVERED = 4, 6, 0.6

_CC = "this work is licensed under a creative commons attribution {} 4.0 international license"

#: Label -> wordings of public licenses and of the notices that name them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "licensed under the apache license, version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "mit": (
        "released under the mit license", "licensed under the mit license", "distributed under the mit license",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "bsd": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    "isc": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    "gpl": (
        "licensed under the gnu general public license, version 3", "licensed under the gnu general public license, version 2",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version.""",
    ),
    "mpl-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    "unlicense": (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
    "cc-by": ("licensed under cc by 4.0", _CC.format("")),
    "cc-by-nc": ("licensed under cc by-nc 4.0", _CC.format("noncommercial")),
    "cc-by-sa": ("licensed under cc by-sa 4.0", _CC.format("sharealike")),
    "cc-by-nd": ("licensed under cc by-nd 4.0", _CC.format("noderivatives")),
}


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of letters, digits and everything beyond ASCII."""
    # lower() is the fast way; of the letters beyond ASCII, two would become ASCII ones and get a stand-in
    plain = F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.regexp_extract_all(F.lower(plain), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def _gram_hashes(words: Column, k: int) -> Column:
    """Hash of the k words from each position on; none where there are fewer words."""
    at = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1)))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, k)))


def templates(spark, wordings: dict[str, tuple[str, ...]] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """``label, template, tpos, h, gram, n_grams`` of every k-gram of every wording."""
    rows = [(label, i, text) for label, many in wordings.items() for i, text in enumerate(many)]
    t = spark.createDataFrame(rows, "label string, template int, text string").withColumn("words", words_of(F.col("text")))
    t = t.select("label", "template", "words", F.posexplode(_gram_hashes(F.col("words"), k)).alias("tpos", "h"))
    return t.select(
        "label", "template", "tpos", "h", F.slice("words", F.col("tpos") + 1, k).alias("gram"), (F.size("words") - (k - 1)).alias("n_grams")
    )


def rivals(wordings: dict[str, tuple[str, ...]] = TEMPLATES, k: int = GRAM) -> list[tuple[str, int, str, list[list[int]]]]:
    """``label, template, family, telling`` of the wordings that have rivals: what they are rivals in, and per rival the
    positions of the words that it lacks."""
    words = {(label, i): re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) for label, many in wordings.items() for i, text in enumerate(many)}
    grams = {t: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] for t, w in words.items()}
    against: dict[tuple[str, int], list[tuple[str, int]]] = {}
    for a in words:
        for b in words:
            if a[0] != b[0] and grams[a] and grams[b]:
                both = len(set(grams[a]) & set(grams[b]))
                if both >= COVERED * min(len(grams[a]), len(grams[b])):
                    against.setdefault(a, []).append(b)
    family: dict[tuple[str, int], str] = {}
    for a in against:
        todo = [a]
        while todo:
            b = todo.pop()
            if b not in family:
                family[b] = f"{a[0]} {a[1]}"
                todo += against[b]
    return [
        (*a, family[a], [x for b in many if (x := [p for p, w in enumerate(words[a]) if w not in words[b]])]) for a, many in against.items()
    ]


def _told_apart(merged: DataFrame, keep: tuple[str, ...], wordings: dict[str, tuple[str, ...]], k: int) -> DataFrame:
    """The spans with the telling words of their wordings, without those that a rival covers better at the same place."""
    known = rivals(wordings, k)
    if not known:
        return merged
    known = merged.sparkSession.createDataFrame(known, "label string, template int, family string, telling array<array<int>>")
    t = merged.join(F.broadcast(known), ["label", "template"], "left")
    stands = lambda p: F.exists("tpos", lambda x: (x <= p) & (p < x + k))
    t = t.where(F.col("family").isNull() | F.forall("telling", lambda ps: F.exists(ps, stands)))
    # rows of a family that overlap one after the other are an island; rivals are compared inside
    own = F.coalesce("family", F.concat_ws(" ", F.lit(""), "label", "template"))
    t = t.withColumn("family", own)
    order = Window.partitionBy(*keep, "text_key", "family").orderBy("first_word", "end_word", "label", "template")
    reach = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("new", F.coalesce((F.col("first_word") >= reach).cast("int"), F.lit(1)))
    t = t.withColumn("island", F.sum("new").over(order))
    rows = F.collect_list(F.struct("label", "first_word", "end_word", "covered")).over(Window.partitionBy(*keep, "text_key", "family", "island"))
    t = t.withColumn("beside", rows)
    better = F.exists("beside", lambda o: (
        (o["label"] != F.col("label")) & (o["covered"] > F.col("covered"))
        & (o["first_word"] < F.col("end_word")) & (o["end_word"] > F.col("first_word"))
    ))
    return t.where(~better)


def _places(words: Column, line: Column, phrase: str) -> Column:
    """Word positions at which the phrase's words stand one after the other."""
    parts = phrase.split()
    n = len(parts)

    def stands(i: Column) -> Column:
        cond = F.get(words, i) == parts[0]
        for d in range(1, n):
            cond = cond & (F.get(words, i + d) == parts[d])
        return cond

    found = F.filter(F.sequence(F.lit(0), F.size(words) - n), stands)
    return F.when(F.contains(line, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def base_scan(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep, text_key, n_words, n_base, first_word, last_word, base_labels (array)`` of every row; no shuffle."""
    t = texts(docs, *keep, text=text).select(*keep, F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    t = t.withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    t = t.select(
        *keep, "text_key", F.size("words").cast("long").alias("n_words"),
        F.array(*[_places(F.col("words"), F.col("line"), p) for p in PHRASES]).alias("places"),
    )
    every = F.flatten("places")
    label = [F.when(F.size(F.col("places")[i]) > 0, F.lit(name)) for i, name in enumerate(PHRASES.values())]
    return t.select(
        *keep, "text_key", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*label)))).alias("base_labels"),
    )


def spans(docs: DataFrame, *keep: str, text: str = "text", wordings: dict[str, tuple[str, ...]] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """Verified license spans: ``keep, text_key, label, template, first_word, end_word, covered``.

    Only the matches of template k-grams leave their task. Nulls and empty texts match nothing; repeated rows of one id
    and text give their spans once; an empty table gives none.
    """
    t = texts(docs, *keep, text=text).select(*keep, F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    t = t.select(*keep, "text_key", "words", F.posexplode(_gram_hashes(F.col("words"), k)).alias("pos", "gram_hash"))
    known = F.broadcast(templates(docs.sparkSession, wordings, k))
    hits = t.join(known, (F.col("gram_hash") == F.col("h")) & (F.slice("words", F.col("pos") + 1, k) == F.col("gram")))
    hits = hits.select(*keep, "text_key", "label", "template", "n_grams", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
    # one row per diagonal before anything is shuffled on
    one = hits.groupBy(*keep, "text_key", "label", "template", "n_grams", "diagonal").agg(
        F.collect_set("tpos").alias("tpos"), F.min("pos").alias("first_word"), (F.max("pos") + k).alias("end_word")
    )
    order = Window.partitionBy(*keep, "text_key", "label", "template").orderBy("diagonal")
    one = one.withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SLACK).cast("int"), F.lit(1)))
    one = one.withColumn("run", F.sum("new").over(order))
    merged = one.groupBy(*keep, "text_key", "label", "template", "n_grams", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"),
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"),
    )
    merged = merged.withColumn("covered", F.size("tpos") / F.col("n_grams"))
    return _told_apart(merged.where(F.col("covered") >= COVERED), keep, wordings, k).select(
        *keep, "text_key", "label", "template", "first_word", "end_word", "covered"
    )


def scan(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Base places and license labels of every row: ``keep, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``.

    ``score`` is 1 where a base phrase stands, else the largest covered share of a template, 0 without any. Null texts are
    empty; null ids and repeated rows keep their rows; columns not in ``keep`` do not matter.
    """
    base = base_scan(docs, *keep, text=text)
    found = spans(docs, *keep, text=text).groupBy(*keep, "text_key").agg(
        F.collect_set("label").alias("more"), F.max("covered").alias("covered"),
        F.sort_array(F.collect_list(F.struct("first_word", "end_word", "label"))).alias("spans"),
    )
    right = found.select(*[F.col(c).alias(f"_{c}") for c in (*keep, "text_key")], "more", "covered", "spans")
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in keep] + [F.col("_text_key") == F.col("text_key")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    out = base.join(right, cond, "left")
    none = F.array().cast("array<string>")
    return out.select(
        *keep, "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("covered", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<first_word:int,end_word:int,label:string>>")).alias("spans"),
    )
