"""Benchmark passages in documents, by a prefix-filtered join of word shingles (operator 5, DataFrame functions only)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens.session import settle

WINDOW = 10  # words of an item that count as one passage
SHINGLE = 3  # words of a join token
BROADCAST_BYTES = 32 << 20
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _token(of: Column, at: Column, width: int) -> Column:
    """Join token of the ``width`` words from position ``at``; equal shingles have equal tokens."""
    return F.xxhash64(*(F.get(of, at + i) for i in range(width)))


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, passage, n)``: every window of every item as an array of ``n`` words; shorter items are one window."""
    split = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0")
    n = F.least(F.size("w"), F.lit(window))
    starts = split.select("item", "w", n.alias("n"), F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("at"))
    return starts.select("item", F.slice("w", F.col("at") + 1, F.col("n")).alias("passage"), "n").distinct()


def _shingles(passages: DataFrame) -> DataFrame:
    """``(passage, n, width, offset, token)``: the shingles of every passage."""
    width = F.least(F.col("n"), F.lit(SHINGLE))
    rows = passages.select("passage", "n", width.alias("width")).withColumn("offset", F.explode(F.expr("sequence(0, n - width)")))
    cases = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        cases = F.when(F.col("width") == k, _token(F.col("passage"), F.col("offset"), k)).otherwise(cases)
    return rows.withColumn("token", cases)


def _doc_tokens(docs: DataFrame, widths: list[int], keep_words: bool) -> DataFrame:
    """``(row, at, width, token)`` of every shingle position of every document ``(row, w)``."""
    split = docs.select("row", "w").filter(F.size("w") >= min(widths))
    rows = split.select("row", "w", F.explode(F.sequence(F.lit(0), F.size("w") - min(widths))).alias("at"))
    tokens = [F.struct(F.lit(k).alias("width"), _token(F.col("w"), F.col("at"), k).alias("token")) for k in widths]
    if len(tokens) == 1:
        rows = rows.withColumn("t", tokens[0])
    else:
        rows = rows.withColumn("t", F.explode(F.array(*tokens)))
    return rows.select("row", *(["w"] if keep_words else []), "at", F.col("t.width").alias("width"), F.col("t.token").alias("token"))


def _size(df: DataFrame) -> int:
    row = F.lit(64) + F.octet_length(F.concat_ws(" ", "passage")) + 16 * F.size("passage")
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def prefixes(docs: DataFrame, passages: DataFrame, widths: list[int], broadcast_bytes: int) -> DataFrame:
    """The rarest shingle of each passage. A passage lies in a document only if all its shingles do, so any
    one of them is a sufficient prefix; the one that is rarest among all documents is looked for."""
    shingles = settle(_shingles(passages), "shingles")
    tokens = shingles.select("width", "token").distinct()
    small = tokens.count() * 64 <= broadcast_bytes
    found = _doc_tokens(docs, widths, False).join(F.broadcast(tokens) if small else tokens, ["width", "token"], "left_semi")
    counts = found.groupBy("width", "token").agg(F.count("*").alias("seen"))
    ranked = shingles.join(counts, ["width", "token"], "left")  # not in any document: no candidate at all
    first = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "offset")).alias("first")
    rare = ranked.groupBy("passage", "n", "width").agg(first)
    return rare.filter("first.seen > 0").select("passage", "n", "width", "first.token", "first.offset")


def passage_hits(docs: DataFrame, passages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(row, start, n, passage)``: where a passage's words stand in a document ``(row, w)``, verified word by word.

    Beyond ``broadcast_bytes`` of prefixes the documents' tokens are shuffled, and candidates fetch
    their document's words by its row number.
    """
    widths = [r["width"] for r in passages.select(F.least("n", F.lit(SHINGLE)).alias("width")).distinct().collect()]
    if not widths:
        return docs.select("row", F.lit(0).alias("start"), F.lit(0).alias("n"), F.array(F.lit("")).alias("passage")).limit(0)
    rare = settle(prefixes(docs, passages, sorted(widths), broadcast_bytes), "prefixes")
    start = F.col("at") - F.col("offset")
    if _size(rare) <= broadcast_bytes:
        near = _doc_tokens(docs, sorted(widths), True).join(F.broadcast(rare), ["width", "token"])
    else:
        near = _doc_tokens(docs, sorted(widths), False).join(rare.hint("merge"), ["width", "token"])
    near = near.filter(start >= 0).withColumn("start", start)
    if "w" not in near.columns:
        near = near.join(docs.select("row", "w"), "row")
    fits = (F.col("start") + F.col("n") <= F.size("w")) & (F.slice("w", F.col("start") + 1, F.col("n")) == F.col("passage"))
    return near.filter(fits).select("row", "start", "n", "passage")


def covered(spans: Column) -> Column:
    """Number of places that sorted ``(start, end)`` spans cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def further(done: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], done["upto"]), F.lit(0))
        return F.struct((done["n"] + fresh).alias("n"), F.greatest(done["upto"], span["end"]).alias("upto"))

    return F.aggregate(spans, start, further, lambda done: done["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    numbered: bool = False,
) -> DataFrame:
    """``(id, n_words, hit_words, items)`` for every row of ``docs``: its words, how many of them lie inside
    an occurrence of an item's window, and the sorted ids (as text) of the items whose windows occur.

    Null and empty texts and items have no words. Every row is a document of its own, whatever its id:
    ids may be null, repeated and of any type; other columns are not looked at. Empty tables give no rows,
    or no hits. Texts are split once; what is written for later passes are their words. ``numbered`` says
    that ``docs`` is a written table whose ids number its rows: then nothing is written, and each pass splits texts.
    """
    found = docs.select(F.col(id_col).alias("id"), (F.col(id_col) if numbered else F.monotonically_increasing_id()).alias("row"), words(F.col(text_col)).alias("w"))
    if not numbered:
        found = settle(found, "words")
    windows = settle(item_windows(items, window, item_id, item_text), "windows")
    hits = settle(passage_hits(found, windows.select("passage", "n").distinct(), broadcast_bytes).distinct(), "hits")
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    named = windows.groupBy("passage").agg(F.collect_set("item").alias("items"))
    both = hits.join(named, "passage").groupBy("row").agg(
        covered(spans).alias("hit_words"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    return found.select("id", "row", F.size("w").cast("long").alias("n_words")).join(both, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("hit_words", F.lit(0).cast("long")).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
