"""License scans by diagonal voting. DataFrame functions only.

Rolling word k-grams of texts are joined by hash to the places where license templates have them. A match of word i of
the text with word j of a template votes for diagonal i - j: a verbatim copy puts all its votes on one, and a copy with
words added or left out on neighbouring ones. A band of neighbouring diagonals is a span; it is verified by the words
of the template that its votes cover, each place counted once however often it is voted for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import let

#: Phrases of the base, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices and whole texts of licenses, words in lower case, without names, years and headings; and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        "the software or the use or other dealings in the software",
        "mit",
    ),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache",
    ),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details "
        "you should have received a copy of the gnu general public license along with this program",
        "gpl",
    ),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness "
        "for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        "isc",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", "mpl"),
    ("this work is licensed under a creative commons attribution share alike license", "cc"),
    ("this work is licensed under the creative commons attribution 4 0 international license", "cc"),
)
#: Words of a gram for templates; phrases, which are shorter, vote by grams of PAIR words.
GRAM, PAIR = 4, 2
#: A span is a diagonal with those this near on either side: words that a copy adds or leaves out.
NEAR = 8
#: Of a template's words, the part that the votes of a verified span must cover.
COVERED = 0.6
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_rows() -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, whether a phrase, number of words, place, gram): a rolling row for each place of the texts above."""
    rows = []
    for n, (text, label) in enumerate((*PHRASES, *TEMPLATES)):
        words, phrase = text.split(), n < len(PHRASES)
        k = PAIR if phrase else GRAM
        rows += [(n, label, phrase, len(words), i, " ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
    return rows


def _values() -> str:
    return ", ".join(f"({n}, '{label}', {phrase}, {size}, {place}, '{gram}')" for n, label, phrase, size, place, gram in template_rows())


def _templates(spark: SparkSession) -> DataFrame:
    return spark.sql(f"select t.*, xxhash64(tgram) as thash from values {_values()} as t(template, label, phrase, size, place, tgram)")


def _grams(w: Column) -> Column:
    """Hashes of the GRAM words that begin at each word, then of the PAIR words there if the second can end a gram of a phrase.

    A hash is of the gram's text, so that it joins to templates; a null at the front stands for the row itself.
    """
    seconds = sorted({g.split()[-1] for _, _, phrase, _, _, g in template_rows() if phrase})
    join = lambda i, k: F.concat_ws(" ", *[F.get(w, i + d) for d in range(k)])
    firsts = sorted({g.split()[0] for _, _, phrase, _, _, g in template_rows() if not phrase})
    long = F.transform(w, lambda x, i: F.when(x.isin(*firsts) & F.get(w, i + (GRAM - 1)).isNotNull(), F.xxhash64(join(i, GRAM))))  # a gram whose first word begins none of the templates' is null: it can't match
    short = F.transform(w, lambda x, i: F.when(F.get(w, i + 1).isin(*seconds), F.xxhash64(join(i, PAIR))))
    return F.concat(F.array(F.lit(None).cast("long")), long, short)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Grams that match by hash are compared by their words before they vote. A base place is a diagonal that holds all of a
    phrase's votes. A diagonal of a template, taken with those at most NEAR from it, is a span: it counts if its votes
    cover COVERED of the template's words, each word once, and no diagonal near it covers more. So nothing that stands
    around a copy can add to it or take it away, and repeated words of a template cover it once. score is the best
    coverage of a phrase (1) or template, 0 without any. spans are (label, first word, words, coverage) of both, in order.

    Null text is empty: no words, no places, empty labels. Repeated rows are scanned each; an empty table gives no
    rows; other columns are ignored. Rows of a text, however long, are spread by explode and shrink to its matches
    before they are shuffled; votes are counted in partial sums.
    """
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(lower, NOT_WORDS), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", let(words, lambda w: F.struct(w.alias("w"), _grams(w).alias("grams"))).alias("x"))
    rows = rows.select("row", "doc_id", F.col("x.w").alias("w"), F.size("x.w").cast("long").alias("n_words"), F.posexplode("x.grams").alias("at", "hash"))
    rows = rows.where("at = 0 or hash is not null")
    at = F.when(F.col("at") > F.col("n_words"), F.col("at") - F.col("n_words")).otherwise(F.col("at")) - 1
    k = F.when(F.col("at") > F.col("n_words"), PAIR).otherwise(GRAM)
    said = F.array_join(F.slice("w", F.when(F.col("at") == 0, F.lit(1)).otherwise(at.cast("int") + 1), k), " ")
    matched = rows.join(F.broadcast(_templates(docs.sparkSession)), (F.col("hash") == F.col("thash")) & (said == F.col("tgram")), "left")
    votes = matched.where("at = 0 or template is not null").select("row", "doc_id", "n_words", "template", "label", "phrase", "size", "place", (at - F.col("place")).cast("long").alias("diagonal"))
    key = ("row", "doc_id", "n_words", "template", "label", "phrase", "size")
    by_diagonal = votes.groupBy(*key, "diagonal").agg(F.collect_list(F.when(~F.col("phrase"), F.col("place"))).alias("places"), F.count("place").alias("votes"))

    along = Window.partitionBy("row", "template").orderBy("diagonal")
    band = along.rangeBetween(-NEAR, NEAR)
    # the words that votes cover: each vote covers GRAM words from its place on
    places = F.array_sort(F.array_distinct(F.flatten(F.collect_list("places").over(band))))
    spans = by_diagonal.withColumn("all_places", F.when(~F.col("phrase"), places)).withColumn("covered", _covered(F.col("all_places")))
    base = F.coalesce(F.col("phrase") & (F.col("votes") == F.col("size") - PAIR + 1), F.lit(False))
    best = F.max(F.struct("covered", (-F.col("diagonal")).alias("e"))).over(band)
    spans = spans.withColumn("best", best).withColumn("base", base)
    share = F.col("covered") / F.col("size")
    notice = F.coalesce(~F.col("phrase") & (share >= COVERED) & (F.col("best.e") == -F.col("diagonal")), F.lit(False))
    spans = spans.withColumn("notice", notice).withColumn("share", F.when(F.col("base"), 1.0).otherwise(share))
    low = F.when(F.col("base"), F.col("diagonal")).otherwise(F.greatest(F.lit(0).cast("long"), F.col("diagonal") + F.get("all_places", F.lit(0))))
    span = F.struct(low.alias("first_word"), "label", F.when(F.col("base"), F.col("size")).otherwise(F.col("covered")).cast("long").alias("n_words"), F.col("share").alias("coverage"))
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("diagonal"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("diagonal"))).alias("last_word"),
        names(F.col("base")).alias("base_labels"), names(F.col("base") | F.col("notice")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("base") | F.col("notice"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("base") | F.col("notice"), span))).alias("spans"),
    ).drop("row")


def _covered(places: Column) -> Column:
    """Words of a template under the grams at these distinct places, in order: each word once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("int").alias("end"))
    step = lambda s, p: F.struct((s["n"] + F.least(F.lit(GRAM), p + GRAM - F.greatest(s["end"], F.lit(0)))).cast("long").alias("n"), (p + GRAM).cast("int").alias("end"))
    return F.aggregate(places, start, step)["n"]


def oracle() -> str:
    """The same definition in DuckDB SQL, by a join of diagonals and lists of covered words instead of windows."""
    return rf"""
with t(template, label, phrase, size, place, tgram) as (values {_values()}),
d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NOT_WORDS}'), lambda x: x <> '') as w from documents),
i as (select r, w, unnest(range(0, len(w))) as i from d),
g as (select r, i, array_to_string(w[i + 1 : i + k], ' ') as gram from i, (values ({GRAM}), ({PAIR})) as n(k) where i + k <= len(w)),
v as (select r, template, label, phrase, size, i - place as diagonal, place from g join t on gram = tgram),
b as (select r, label, diagonal from v where phrase group by r, template, label, size, diagonal having count(*) = size - {PAIR - 1}),
c as (select distinct r, template, label, size, diagonal from v where not phrase),
a as (select c.r, c.template, c.label, c.size, c.diagonal, len(list_distinct(flatten(list([v.place, v.place + 1, v.place + 2, v.place + 3])))) as covered
  from c join v on c.r = v.r and c.template = v.template and abs(c.diagonal - v.diagonal) <= {NEAR} group by all),
s as (select r, label, covered / size as share from a where covered / size >= {COVERED}),
x as (select r, string_agg(distinct label, ',' order by label) as labels, max(share) as score from (select r, label, 1.0 as share from b union all select * from s) group by r),
y as (select r, count(*) as n, min(diagonal) as lo, max(diagonal) as hi, string_agg(distinct label, ',' order by label) as labels from b group by r)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(y.n, 0) as n_base, y.lo as first_word, y.hi as last_word,
  coalesce(y.labels, '') as base_labels, coalesce(x.labels, '') as labels, cast(coalesce(x.score, 0) as double) as score
from d left join x on x.r = d.r left join y on y.r = d.r
"""
