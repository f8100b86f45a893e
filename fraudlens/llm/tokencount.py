"""Token counts by a two-tier lookup of pre-token lengths (operator 4)."""

from __future__ import annotations

import os
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import in_chunks, ship

CHUNK = 4 << 20  # characters of text that a task looks up at once
TABLE = 65_536  # entries of the broadcast table
SUMMARY = 2_048  # most frequent pre-tokens that a task reports
COUNTED = 200_000  # distinct pre-tokens a task counts before it forgets the rare ones
WORD = 32  # characters of a pre-token that the table and the caches hold at most
CACHED = 150_000  # pre-tokens in each of the two generations of a worker's cache

# Fixed values of the vocabulary file: its split pattern and its special strings
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

# beyond these planes the library's Unicode tables are not the ones used here
_BEYOND = regex.compile("[\U00030000-\U0010ffff]")
_SPLIT = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}"))


def pre_tokens(text: str) -> list[str] | None:
    """Pre-tokens of a text, None if it must go to the library whole, as with special strings inside."""
    if not text.isascii():
        if _BEYOND.search(text):
            return None
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form of sigma
    if "<|" in text and any(s in text for s in SPECIAL):
        return None
    return _SPLIT.findall(text.lower())


class Counter2:
    """Lengths of pre-tokens: the frequent ones from a table, the others through a bounded cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.frequent = frequent
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        split = [pre_tokens(t) for t in texts]
        made = [list(map(self.frequent.get, s)) if s is not None else None for s in split]
        missed = {w for s, m in zip(split, made) if m and None in m for w, n in zip(s, m) if n is None}
        for w in missed & self.old.keys() - self.young.keys():
            self.young[w] = self.old[w]
        fresh = list(missed - self.young.keys())
        known = dict(zip(fresh, self.lengths(fresh)))
        counts = []
        for text, s, m in zip(texts, split, made):
            if s is None:
                counts.append(self.lengths([text])[0])
            elif None in m:
                young = self.young
                rare = [w for w, n in zip(s, m) if n is None]
                counts.append(sum(filter(None, m)) + sum([young[w] if w in young else known[w] for w in rare]))
            else:
                counts.append(sum(m))
        self.young.update((w, n) for w, n in known.items() if len(w) <= WORD)
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        return counts


_COUNTERS: dict[str, tuple[str, Counter2]] = {}


def frequent_pre_tokens(docs: DataFrame, text_col: str = "text", size: int = TABLE) -> list[str]:
    """The corpus' most frequent pre-tokens, from all texts. Each task reports its own most frequent ones
    only, so what is exchanged and what reaches the driver (``size`` short strings) is bounded."""

    def trimmed(counts: Counter) -> Counter:
        return Counter(dict(counts.most_common(COUNTED // 4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pre_tokens(text or "") or ())
                if len(counts) > COUNTED:
                    counts = trimmed(counts)
        top = [(w, n) for w, n in counts.most_common(SUMMARY) if len(w) <= WORD and n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["w", "n"])

    found = docs.select(text_col).mapInArrow(run, "w string, n long")
    top = found.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r["w"] for r in top.select("w").collect()]


def count_tokens(
    docs: DataFrame, locate: Callable[[], str], limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every whole text; null and empty texts have no tokens.

    ``locate`` gives the vocabulary file's path, on the driver and on the workers. A first pass finds the
    frequent pre-tokens; a second looks up every pre-token in the broadcast table (at most ``TABLE``
    entries of ``WORD`` characters) and encodes the others through worker caches. Pre-tokens are not
    shuffled. A text with special strings goes to the library whole, which takes them as tokens. Other
    columns are not looked at; repeated rows are counted one by one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    words = frequent_pre_tokens(docs, text_col)
    table = spark.sparkContext.broadcast((uuid.uuid4().hex, words, Counter2(locate(), {}).lengths(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, (key, *known) = locate(), table.value
        if _COUNTERS.get(path, ("",))[0] != key:
            _COUNTERS[path] = key, Counter2(path, dict(zip(*known)))
        count = _COUNTERS[path][1]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for part in in_chunks(rows, lambda r: len(r[1] or ""), CHUNK):
                made = count([t or "" for _, t in part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in part], pa.int64()),
                        pa.array([len((t or "").encode()) for _, t in part], pa.int64()),
                        pa.array(made, pa.int64()),
                    ],
                    ["id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
