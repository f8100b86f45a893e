"""BPE encoding and decoding by batched merge rounds over flat arrays (operator 12)."""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.bytebpe import splitter
from fraudlens.llm.common import in_chunks, ship

CHUNK = 4 << 20  # characters of text that a task holds at once
FLAT = 1 << 20  # bytes of words whose symbols share one array
LONG_WORD = 1024  # bytes beyond which a word's pairs go through a heap instead of rounds
LONG_TEXT = 1 << 20  # characters beyond which a text is split lazily
CACHED = 150_000  # words in each of the two generations of a worker's cache
CACHED_LENGTH = 48
NONE = np.iinfo(np.int32).max

# Fixed value of the vocabulary's kind: how it splits a text into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable in
    Latin-1, else the next free one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class MergeTable:
    """A byte-level vocabulary: symbols of bytes, pairs that merge, and the bytes of every token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, kind = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if spec["normalizer"] or spec["post_processor"] or not plain or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError("a byte-level vocabulary without normalizer and prefix space is needed")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their neighbours are not supported")
        shown = byte_characters()
        back = {c: bytes([b]) for b, c in enumerate(shown)}
        self.symbol = np.array([vocab[c] for c in shown], np.int64)
        size = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for text, i in vocab.items():
            tokens[i] = b"".join([back[c] for c in text])
        for text, i in self.special.items():
            tokens[i] = text.encode()
        self.token_ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        self.token_sizes = np.array([len(t) for t in tokens], np.int64)
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[t] for t in ts], np.int64) for ts in (*zip(*pairs), ["".join(p) for p in pairs]))
        self.base = size
        keys = left * size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        last = np.full(size, -1)  # latest merge that makes a token
        np.maximum.at(last, made, np.arange(len(made)))
        # then merges of one round cannot bring up a pair that should have come before one of them
        self.ordered = bool((np.maximum(last[left], last[right]) < np.arange(len(made))).all())

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NONE`` where it does not merge) and the symbol it merges to."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.made[at]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has.

        In a round every word merges all places of its lowest-ranked pair, from left to right; a word
        without such a pair leaves the array.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        flat = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        name = np.arange(len(words))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(flat):
            begins = np.cumsum(sizes) - sizes
            rank, made = self.look_up(flat, np.append(flat[1:], 0))
            rank[begins + sizes - 1] = NONE  # the last symbol has no right neighbour
            least = np.minimum.reduceat(rank, begins)
            open_ = least < NONE
            if not open_.all():
                stays = np.repeat(open_, sizes)
                done.append((name[~open_], sizes[~open_], flat[~stays]))
                flat, rank, made, name, sizes, least = flat[stays], rank[stays], made[stays], name[open_], sizes[open_], least[open_]
                if not len(flat):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            word = np.repeat(np.arange(len(sizes)), sizes)[at]
            if self.ordered:  # of places that overlap, as in "aaa", every second one
                first = np.append(True, np.diff(at) != 1)
                run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                take = (np.arange(len(at)) - run) % 2 == 0
            else:
                take = run_begins(word)
            at, word = at[take], word[take]
            flat[at] = made[at]
            flat = np.delete(flat, at + 1)
            sizes = sizes - np.bincount(word, minlength=len(sizes))
        name, sizes = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int64) for i in (0, 1))
        flat = np.concatenate([d[2] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(name)
        counts = sizes[order]
        begins = (np.cumsum(sizes) - sizes)[order]
        place = np.arange(len(flat)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
        return flat[place], counts

    def encode_long(self, word: bytes) -> np.ndarray:
        """Ids of one very long word: pairs wait in a heap by rank and place, symbols are a linked list."""
        ids = self.symbol[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, _ = self.look_up(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        at = np.flatnonzero(rank < NONE)
        heap = [(int(r), int(i), ids[i], ids[i + 1]) for r, i in zip(rank[at], at)]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def pair(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in known:
                r, m = self.look_up(np.array([a]), np.array([b]))
                known[a, b] = int(r[0]), int(m[0])
            return known[a, b]

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = pair(a, b)[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and pair(ids[x], ids[y])[0] < NONE:
                    heapq.heappush(heap, (pair(ids[x], ids[y])[0], x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens in a row."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.token_bytes[np.arange(total) + np.repeat(self.token_ends[ids] - ends, sizes)].tobytes()


def run_begins(names: np.ndarray) -> np.ndarray:
    """Whether each place of a sorted array differs from the one before."""
    return np.append(True, names[1:] != names[:-1])[:len(names)]


class WordEncoder:
    """A merge table with a bounded cache of words; all words of a batch that it lacks are encoded at once."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.split = splitter(PATTERN)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(table.special, key=len, reverse=True)))) if table.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _parts(self, text: str) -> Iterator[tuple[str, str | None]]:
        """Stretches of ordinary text, each with the special token behind it."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            yield text[at:mark.start()], mark.group()
            at = mark.end()
        yield text[at:], None

    def _words(self, text: str) -> Iterator[list[str]]:
        """Words of a text, lazily where it is long; a special token is a word of its own, led by a zero byte."""
        for part, mark in self._parts(text):
            if len(part) <= LONG_TEXT:
                found = self.split.findall(part)
            else:
                lazy = (m.group() for m in self.split.finditer(part))
                while len(found := list(islice(lazy, 100_000))) == 100_000:
                    yield found
            yield found + ["\0" + mark] if mark else found

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of words that the cache lacks."""
        made, short = {}, []
        for w in words:
            if w[0] == "\0" and w[1:] in self.table.special:
                made[w] = np.array([self.table.special[w[1:]]], np.int32).tobytes()
            elif len(data := w.encode()) > LONG_WORD:
                made[w] = self.table.encode_long(data).astype(np.int32).tobytes()
            else:
                short.append((w, data))
        for part in in_chunks(iter(short), lambda p: len(p[1]), FLAT):
            ids, counts = self.table.encode_words([data for _, data in part])
            packed, ends = ids.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
            made.update((w, packed[a:b]) for (w, _), a, b in zip(part, [0, *ends], ends))
        return made

    def _ids(self, found: list[list[str]]) -> list[bytes]:
        """Packed ids of several lists of words."""
        young, old = self.young, self.old
        looked = [list(map(young.get, words)) for words in found]
        missed = {w for words, ids in zip(found, looked) if None in ids for w, i in zip(words, ids) if i is None}
        fresh = {w: old[w] for w in missed if w in old}
        fresh |= self._learn(missed - fresh.keys())
        out = [b"".join([i or fresh[w] for w, i in zip(words, ids)]) if None in ids else b"".join(ids) for words, ids in zip(found, looked)]
        young.update((w, i) for w, i in fresh.items() if len(w) <= CACHED_LENGTH)
        if len(young) > CACHED:
            self.old, self.young = young, {}
        return out

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain = [i for i, t in enumerate(texts) if len(t) <= LONG_TEXT]
        made = dict(zip(plain, self._ids([[w for words in self._words(texts[i]) for w in words] for i in plain])))
        for i, text in enumerate(texts):
            if i not in made:
                made[i] = b"".join(self._ids([words])[0] for words in self._words(text))
        return [np.frombuffer(made[i], np.int32) for i in range(len(texts))]


_ENCODERS: dict[str, WordEncoder] = {}


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, built once for each vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(MergeTable(path))
    return _ENCODERS[path]


def encode_by_merges(docs: DataFrame, locate: Callable[[], str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded string)`` of every whole text; null and empty texts have no ids.

    ``locate`` is called on the worker and gives the vocabulary file's path there. Special strings inside a
    text become special tokens, as is the library's default, and are decoded to their own text. ``decoded``
    is made from the ids, bytes that are no UTF-8 replaced. Ids of any type, null and repeated ones
    included; other columns are not looked at. No shuffle; an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(locate())
        for batch in batches:
            at = 0
            for part in in_chunks(iter(batch.column(1).to_pylist()), lambda t: len(t or ""), CHUNK):
                made = encoder([t or "" for t in part])
                ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
                decoded = [encoder.table.decode(ids).decode("utf-8", "replace") for ids in made]
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), ids, pa.array(decoded, pa.string())], ["id", "ids", "decoded"])
                at += len(part)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string"
    return rows.mapInArrow(run, kinds).withColumnRenamed("id", id_col)
