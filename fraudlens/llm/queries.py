"""One query per corpus operator, with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.llm.common import table
from fraudlens.llm.bytebpe import digests, encode_documents
from fraudlens.llm.decontaminate import contamination
from fraudlens.llm.licences import TEMPLATES, licence_scan
from fraudlens.llm.lines import line_dedup
from fraudlens.llm.mergebpe import encode_by_merges
from fraudlens.llm.middle import fill_in_middle, restored
from fraudlens.llm.resample import importance_resample
from fraudlens.llm.simhash import simhash_groups
from fraudlens.llm.substring import substring_dedup
from fraudlens.llm.suffix import suffix_dedup
from fraudlens.llm.tokencount import count_tokens
from fraudlens.llm.toxicity import score_toxicity, train_toxicity
from fraudlens.llm.vectors import vector_groups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def merge_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


TOXIC = 0.7  # score from which a text counts as toxic


def held_out():
    """Rows whose labels are never learnt from. A row without an id has no label, so it is not one of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


OP2 = """
WITH RECURSIVE
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
deg AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN least ON vec_id = least.u LEFT JOIN deg ON vec_id = deg.u"""


@query("op2_vector_groups", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


OP3 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) - 18 AS BIGINT))) AS s FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM late),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, CAST(len(w) + 1 AS BIGINT))) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op3_substring_dedup", OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), word_bpe, limit=2048)


OP5 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS p
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM iw WHERE len(w) > 0)),
pos AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, s, pos.n, item FROM pos JOIN win ON pos.p = win.p AND pos.n = win.n),
agg AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN agg USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op5_decontamination", OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.col("hit_words").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("hit_words") > 0).alias("contaminated"),
    )


OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS k
  FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 - 49 AS BIGINT))) AS s FROM d WHERE length(h) >= 100)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM late),
bytes AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM d)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(b, '' ORDER BY p) AS t FROM bytes ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
spans AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM gone)
          WHERE gap IS NULL OR gap > 1 GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, length(h) // 2 - coalesce(kept.n, 0) AS n_removed, coalesce(spans.n, 0) AS n_spans,
       sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)"""


@query("op6_suffix_dedup", OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _values() -> str:
    quoted = [(licence, text.replace("'", "''")) for licence, text in TEMPLATES]
    return ", ".join(f"({i}, '{licence}', '{text}')" for i, (licence, text) in enumerate(quoted))


def _bigrams(w: str) -> str:
    return f"CASE WHEN len({w}) > 1 THEN list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])) ELSE {w} END"


def _words(text: str) -> str:
    return f"""list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


OP7 = f"""
WITH t AS (SELECT template, licence, {_bigrams('w')} AS b FROM (
       SELECT template, licence, {_words('text')} AS w FROM (VALUES {_values()}) v(template, licence, text))),
tb AS (SELECT template, licence, len(b) AS b, unnest(b) AS bigram FROM t),
lines AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
units AS (
  SELECT doc_id, unnest(l) AS text, unnest(range(0, len(l))) AS unit FROM lines
  UNION ALL SELECT doc_id, text, -1 FROM lines WHERE len(l) > 1),
ub AS (SELECT doc_id, unit, {_bigrams('w')} AS a FROM (SELECT doc_id, unit, {_words('text')} AS w FROM units)),
ur AS (SELECT doc_id, unit, len(a) AS a, unnest(a) AS bigram FROM ub),
hits AS (
  SELECT doc_id, unit, template, licence, 2.0::DOUBLE * count(*) / (a + b) AS dice
  FROM ur JOIN tb USING (bigram) GROUP BY doc_id, unit, a, template, licence, b),
found AS (
  SELECT doc_id, greatest(count(DISTINCT unit) FILTER (unit >= 0), 1) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS l, max(dice) AS d
  FROM hits WHERE dice >= 0.8 GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_notices, coalesce(l, '') AS licences, coalesce(d, 0.0::DOUBLE) AS best_dice
FROM documents LEFT JOIN found USING (doc_id)"""


@query("op7_licence_scan", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_notices", F.concat_ws(",", "licences").alias("licences"), "best_dice")


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    return digests(encode_documents(table(spark, sf_dir, "documents"), byte_bpe, PATTERN))


@query("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@query("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || doc_id) AS h FROM documents),
r AS (
  SELECT doc_id, text, l, len(l) AS n, list_transform(range(0, 4), lambda i: CAST('0x' || substr(h, CAST(8 * i + 1 AS INT), 8) AS BIGINT)) AS r FROM d),
c AS (
  SELECT doc_id, text, l, n, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
              WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM r),
p AS (
  SELECT doc_id, text, n, form, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""


@query("op11_fill_in_middle", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50)
    again = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")
    )


@query("op12_merge_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_by_merges(table(spark, sf_dir, "documents"), merge_bpe))


OP13 = f"""
WITH RECURSIVE
steps(b, k, c) AS (
  SELECT b, 0, b FROM range(0, 256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
dw AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
du AS (SELECT doc_id, unnest(w) AS word FROM dw),
tu AS (SELECT unnest({_words("coalesce(text, '')")}) AS word FROM benchmark),
vocab AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM du UNION SELECT word FROM tu)),
bytes AS (
  SELECT word, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b FROM vocab),
bucket AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc),
src AS (SELECT bucket, count(*) AS n FROM du JOIN bucket USING (word) GROUP BY bucket),
tgt AS (SELECT bucket, count(*) AS n FROM tu JOIN bucket USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM du) AS s, (SELECT count(*) FROM tu) AS t),
gain AS (
  SELECT src.bucket, CAST(floor(1000 * ln((coalesce(tgt.n, 0) + 1)::DOUBLE * (s + 10000)::DOUBLE / ((src.n + 1)::DOUBLE * (t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM src LEFT JOIN tgt USING (bucket), totals),
summed AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM du JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM dw LEFT JOIN summed USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""


@query("op13_importance_resample", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000, least_words=20, percent=10, seed=2024
    )
