"""Licence notices in documents, by the Dice coefficient over word bigrams (operator 7, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fraudlens.llm.decontaminate import words
from fraudlens.llm.licence_texts import TEXTS
from fraudlens.session import settle

SIMILAR = 0.8

# Notices and licence texts as their publishers word them
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def bigrams(w: Column) -> Column:
    """Different pairs of neighbouring words; a single word stands for itself."""
    pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda x, y: F.concat(x, F.lit(" "), y))
    return F.when(F.size(w) > 1, F.array_distinct(pairs)).otherwise(w)


def _token(w: Column, at: Column) -> Column:
    return F.xxhash64(F.get(w, at), F.get(w, at + 1))


def _places(w: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))))


def template_prefixes(spark: SparkSession, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """``(template, licence, known, token)``: bigrams of which a unit like the template has one at least.

    A coefficient of ``least`` needs least / (2 - least) of the template's b bigrams, so one of any
    b - that + 1 of them; the longest are taken, as long words are rare. As many rows as the list fixes.
    """
    table = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(k).alias("licence"), F.lit(t).alias("text")) for i, (k, t) in enumerate(templates)))
    rows = spark.range(1).select(F.explode(table).alias("t")).select("t.template", "t.licence", words(F.col("t.text")).alias("w"))
    rows = rows.filter("size(w) > 0").select("template", "licence", "w", bigrams(F.col("w")).alias("known"), _places(F.col("w")).alias("at"))
    rows = rows.select("template", "licence", "known", F.concat_ws(" ", F.slice("w", F.col("at") + 1, 2)).alias("bigram"), _token(F.col("w"), F.col("at")).alias("token"))
    rank = F.row_number().over(Window.partitionBy("template").orderBy(F.desc(F.length("bigram")), "bigram"))
    needed = F.ceil(F.size("known") * (least / (2 - least)) - 1e-9)
    return rows.dropDuplicates(["template", "bigram"]).withColumn("rank", rank).filter(F.col("rank") <= F.size("known") - needed + 1).drop("rank", "bigram")


def licence_matches(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, unit, licence, dice)``: lines (by number) and whole texts (unit -1) that resemble a template.

    Lines and texts are normalised to words in lower case. Units that share a prefix bigram with a
    template are its candidates. With a bigrams in the unit and b in the template, the coefficient
    2c / (a + b) reaches ``least`` only if a and b lie within a factor of (2 - least) / least, which is
    asked before the shared bigrams c are counted. The prefixes are broadcast: their number is fixed by
    the given list. A unit is returned once per licence, with its best coefficient.
    """
    known = template_prefixes(docs.sparkSession, templates, least)
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = F.when(F.contains(text, F.lit("\n")), text)  # a text of one line is that line
    rows = docs.select(F.col(id_col).alias("id"), F.posexplode(F.concat(F.array(whole), F.split(text, "\n"))).alias("at", "unit_text"))
    rows = rows.select("id", (F.col("at") - 1).alias("unit"), words(F.col("unit_text")).alias("w"))
    rows = rows.select("id", "unit", "w", _places(F.col("w")).alias("at")).withColumn("token", _token(F.col("w"), F.col("at")))
    near = rows.join(F.broadcast(known), "token").select("id", "unit", "licence", "known", bigrams(F.col("w")).alias("all"))
    a, b, factor = F.size("all"), F.size("known"), (2 - least) / least
    dice = F.when((a <= b * factor) & (b <= a * factor), 2.0 * F.size(F.array_intersect("all", "known")) / (a + b))
    # asked behind the aggregation: a filter before it would become a condition of the join, which then would
    # copy a unit's words for each of its places
    found = near.groupBy(F.col("id").alias(id_col), "unit", "licence").agg(F.max(dice).alias("dice"))
    return found.filter(F.col("dice") >= least)


def window_templates(spark: SparkSession, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """``(template, licence, known, length, enough, tokens)``: half of a template's bigrams, with their offsets.

    A unit like the template has least / (2 - least) of its bigrams, so it lacks at most the others; of any
    half of them it has ``enough``. The longest are taken, as long words are rare.
    """
    table = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(k).alias("licence"), F.lit(t).alias("text")) for i, (k, t) in enumerate(templates)))
    rows = spark.range(1).select(F.explode(table).alias("t")).select("t.template", "t.licence", words(F.col("t.text")).alias("w")).filter("size(w) > 0")
    rows = settle(rows.select("template", "licence", "w", bigrams(F.col("w")).alias("known"), F.size("w").alias("length")), "templates")
    numbers = F.sequence(F.lit(0), F.greatest(F.size("w") - 2, F.lit(0)))
    pair = lambda i: F.struct(F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)).alias("bigram"), _token(F.col("w"), i).alias("token"), i.alias("at"))
    b = F.size("known")
    lacking = b - F.ceil(b * (least / (2 - least)) - 1e-9)
    taken = F.greatest(F.ceil(b / 2), lacking + 1)
    places = rows.select("template", taken.alias("taken"), F.explode(F.transform(numbers, pair)).alias("p")).select("template", "taken", "p.*")
    first = places.groupBy("template", "taken", "bigram", "token").agg(F.min("at").alias("offset"))
    rank = F.row_number().over(Window.partitionBy("template").orderBy(F.desc(F.length("bigram")), "bigram"))
    chosen = first.withColumn("rank", rank).filter(F.col("rank") <= F.col("taken"))
    tokens = chosen.groupBy("template").agg(F.collect_list(F.struct("token", "offset")).alias("tokens"))
    return rows.select("template", "licence", "known", "length", (taken - lacking).cast("int").alias("enough")).join(tokens, "template")


def window_matches(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES + TEXTS, least: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, licence, start, length, dice)``: runs of a template's length of words, over line ends, that resemble it.

    A document that has too few of a template's chosen bigrams has no such run. In the others runs are placed
    where bigrams stand as in the template: of the places within a sixteenth of its length, the commonest.
    """
    table = settle(window_templates(docs.sparkSession, templates, least), "templates")
    tokens = table.select("template", "length", "enough", F.explode("tokens").alias("t")).select("template", "length", "enough", "t.token", "t.offset")
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = text.select("id", words(F.col("text")).alias("w"))
    rows = rows.select("id", "w", _places(F.col("w")).alias("at")).select("id", "at", _token(F.col("w"), F.col("at")).alias("token"))
    hits = rows.join(F.broadcast(tokens), "token").select("id", "template", "length", "enough", "offset", (F.col("at") - F.col("offset")).alias("start"))
    starts = hits.groupBy("id", "template", "length", "enough", "start").agg(F.collect_set("offset").alias("offsets"))
    each = starts.groupBy("id", "template", "length", "enough").agg(F.collect_list(F.struct("start", "offsets")).alias("places"))
    each = each.filter(F.size(F.array_distinct(F.flatten("places.offsets"))) >= F.col("enough"))
    place = each.select("id", "template", "length", F.explode("places").alias("p"))
    near = F.floor(F.col("p.start") / (F.floor(F.col("length") / 16) + 1))
    best = place.groupBy("id", "template", near.alias("block")).agg(F.max(F.struct(F.size("p.offsets").alias("n"), F.col("p.start").alias("start")))["start"].alias("start"))
    best = settle(best.groupBy("id", "template").agg(F.collect_set("start").alias("starts")), "places")
    placed = text.withColumnRenamed("id", "d").join(best, F.col("d").eqNullSafe(F.col("id"))).join(F.broadcast(table.drop("tokens", "enough")), "template")
    runs = placed.select("id", "licence", "known", "length", words(F.col("text")).alias("w"), F.explode("starts").alias("start"))
    begin, size = F.greatest("start", F.lit(0)), F.col("length") + F.least("start", F.lit(0))
    runs = runs.filter(size > 0).select("id", "licence", "known", begin.alias("start"), size.alias("length"), bigrams(F.slice("w", begin + 1, size)).alias("all"))
    dice = 2.0 * F.size(F.array_intersect("all", "known")) / (F.size("all") + F.size("known"))
    return runs.withColumn("dice", dice).filter(F.col("dice") >= least).select(F.col("id").alias(id_col), "licence", "start", "length", "dice")


def unit_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(row, licence, spans)``: where the matched units of ``(row, text)`` begin and end among the words of the whole text."""
    sizes = F.transform(F.split("text", "\n"), lambda line: F.size(words(line)))
    sized = rows.join(found.select("row").distinct(), "row").select("row", sizes.alias("sizes"))
    total = lambda upto: F.aggregate(F.slice("sizes", 1, upto), F.lit(0), lambda x, n: x + n)
    whole = F.col("unit") < 0
    start = F.when(whole, F.lit(0)).otherwise(total(F.greatest("unit", F.lit(0))))
    end = F.when(whole, total(F.size("sizes"))).otherwise(total(F.greatest("unit", F.lit(0)) + 1))
    spans = found.join(sized, "row").select("row", "licence", F.struct(start.alias("start"), end.alias("end")).alias("span"))
    return spans.groupBy("row", "licence").agg(F.collect_set("span").alias("spans"))


def licence_scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text", texts: list[tuple[str, str]] = TEXTS
) -> DataFrame:
    """``(id, n_notices, licences, best_dice)`` for every row of ``docs``: matching units, their licences and the best coefficient.

    Units are lines; the whole text, which counts only where none of its lines matches; and runs of words
    that overlap neither each other nor a unit with the same licence: wrapped, embedded and whole
    licences (``texts``). Null and empty texts have no units. Every row is a document of its own, whatever
    its id: ids may be null, repeated and of any type. Other columns are not looked at. No rows: no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = settle(rows, "texts")
    found = settle(licence_matches(rows, templates, least, "row"), "units")
    runs = settle(window_matches(rows, templates + texts, least, "row"), "runs")
    last = found.groupBy("row").agg(F.max("unit").alias("last"))  # -1: only the whole text matches
    sure = settle(found.join(last, "row").filter("unit >= 0 OR last < 0"), "sure")  # written, so that its size is known to the join with the texts
    taken = settle(unit_spans(rows, sure), "taken")
    overlaps = F.exists("spans", lambda s: (s["start"] < F.col("start") + F.col("length")) & (s["end"] > F.col("start")))
    runs = runs.join(taken, ["row", "licence"], "left").filter(F.col("spans").isNull() | ~overlaps)
    place = (F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("end"))
    by = runs.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct((-F.col("dice")).alias("d"), (-F.col("length")).alias("l"), *place))).alias("runs"),
        F.collect_set("licence").alias("licences"), F.max("dice").alias("best_dice"),
    )

    def free(taken: Column, run: Column) -> Column:
        return ~F.exists(taken, lambda t: (t["start"] < run["end"]) & (t["end"] > run["start"]))

    # the best run first, then those that overlap none taken before
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    taken_runs = F.aggregate("runs", none, lambda t, r: F.when(free(t, r), F.concat(t, F.array(F.struct(r["start"].alias("start"), r["end"].alias("end"))))).otherwise(t))
    apart = F.size(taken_runs)
    lines = F.count_distinct(F.when(F.col("unit") >= 0, F.col("unit")))
    units = found.groupBy("row").agg(F.greatest(lines, F.lit(1)).alias("n"), F.collect_set("licence").alias("licences"), F.max("dice").alias("best_dice"))
    both = units.unionAll(by.select("row", apart.cast("long").alias("n"), "licences", "best_dice"))
    each = both.groupBy("row").agg(
        F.sum("n").alias("n_notices"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("licences")))).alias("licences"), F.max("best_dice").alias("best_dice")
    )
    return rows.select("id", "row").join(each, "row", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("best_dice", F.lit(0.0)).alias("best_dice"),
    )
