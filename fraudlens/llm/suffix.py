"""Removal of byte strings that also start in an earlier document, by blockwise suffix sorting (operator 6)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import grouped, mix64, run_starts, ship
from fraudlens.llm.packed import JUDGED, PACKED, Texts, chunked, judged, pack, returned, split_note, with_note
from fraudlens.session import settle

LENGTH = 50
GRAM = 24  # bytes of an anchor
PERIOD, COVER = 13, (0, 1, 3, 9)  # a perfect difference cover: every difference modulo 13 lies between two of its members
STRIDE = 80  # bytes of a row in a bucket's text
HOT = 1_000  # occurrences from which the windows of an anchor are dealt one by one
SCAN = 1 << 18  # bytes that are scanned at once, so that they stay in the processor's cache
BLOCK = 1 << 18  # suffixes that are sorted at once
CHUNK = 4 << 20  # bytes of text in a chunk, whose runs of windows one task holds; a bucket gets about as many
ROWS = 1 << 14  # rows of a bucket that are cut out of the texts at once
_PLACE = np.uint64((1 << 31) - 1)


def _offsets() -> np.ndarray:
    """For two residues, the least shift that takes both into the cover."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
    return table


_SHIFT = _offsets()
_COVERED = np.isin(np.arange(PERIOD), COVER)


def lanes(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from every position as one integer."""
    return np.ndarray((len(data) - 7,), f"{order}u8", data, strides=(1,))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the 24 bytes from every position; ``data`` goes on for 32 bytes at least."""
    word = lanes(data, "<")
    x = word[:size] * np.uint64(0x9E3779B97F4A7C15)
    x += word[8:size + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x += word[16:size + 16]
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x


class Anchors:
    """Runs of windows of a chunk that share an anchor: the gram of least hash inside the window.

    Equal windows have equal anchors at equal places, wherever they stand, so they meet where their
    anchors meet. ``first`` and ``count`` name the windows of a run, ``gram`` is the anchor's hash.
    """

    def __init__(self, texts: Texts, length: int):
        parts: list[tuple] = []
        for lo, hi in self._blocks(texts):
            parts.append(self._scan(texts, lo, hi, length))
        self.first, self.count, self.gram, self.doc = (np.concatenate(p) if parts else np.zeros(0, np.int64) for p in zip(*parts)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))

    @staticmethod
    def _blocks(texts: Texts) -> Iterator[tuple[int, int]]:
        lo, n = 0, len(texts.texts)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(texts.ends, texts.starts[lo] + SCAN, side="right")))
            yield lo, hi
            lo = hi

    @staticmethod
    def _scan(texts: Texts, lo: int, hi: int, length: int) -> tuple:
        base, end = int(texts.starts[lo]), int(texts.ends[hi - 1])
        size = end - base
        least = np.maximum(texts.ends[lo:hi] - texts.starts[lo:hi] - length + 1, 0)
        n = size - length + 1
        if n <= 0 or not least.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        gram = gram_hashes(texts.bytes[base:], size)
        key = (gram & ~_PLACE) | np.arange(size, dtype=np.uint64)
        # least key of the length - GRAM + 1 positions from each: minima of doubled reach, the last two overlapping
        reach, want = 1, length - GRAM + 1
        while reach * 2 <= want:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        key = np.minimum(key[:n], key[want - reach:want - reach + n])
        at = (key & _PLACE).astype(np.int64)
        inside = np.zeros(size + 1, np.int8)
        some = least > 0
        inside[(texts.starts[lo:hi] - base)[some]] += 1
        np.add.at(inside, (texts.starts[lo:hi] - base + least)[some], -1)
        window = np.flatnonzero(np.cumsum(inside[:n], dtype=np.int8))
        begin = np.flatnonzero(run_starts(at[window]))
        first = window[begin]
        count = np.diff(np.append(begin, len(window)))
        return first + base, count, gram[at[first]], np.searchsorted(texts.ends, first + base, side="right")


def cover_ranks(data: np.ndarray, samples: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the suffix at each sample position by its first ``depth`` bytes, rounded up to eight."""
    word = lanes(data, ">")
    order = np.argsort(word[samples].astype(np.uint64), kind="stable")
    tied = run_starts(word[samples][order].astype(np.uint64))
    for at in range(8, depth, 8):  # refine the runs that are still tied, by the next eight bytes
        run = np.cumsum(tied) - 1
        open_ = np.flatnonzero((np.bincount(run) > 1)[run])
        if not len(open_):
            break
        key = word[samples[order[open_]] + at].astype(np.uint64)
        inner = np.lexsort((key, run[open_]))
        order[open_] = order[open_][inner]
        tied[open_] |= run_starts(key[inner])
    ranks = np.empty(len(samples), np.int64)
    ranks[order] = np.cumsum(tied) - 1
    return ranks


def sorted_blocks(data: np.ndarray, suffixes: np.ndarray, depth: int, most: int = BLOCK) -> Iterator[np.ndarray]:
    """``suffixes`` (positions in ``data``) in lexicographic order by ``depth`` bytes at least, bucket by bucket.

    Only one bucket of suffixes is sorted at a time; a bucket holds those whose first two bytes lie in
    one range. Its suffixes are sorted by 16 bytes; longer ties are parted by the ranks of the difference
    cover sample, which are found once: two suffixes tie over PERIOD bytes at least, and some shift below
    PERIOD takes both to sample positions.
    """
    word = lanes(data, ">")
    near = np.zeros(len(data), bool)
    for shift in range(PERIOD):
        near[suffixes + shift] = True
    samples = np.flatnonzero(near & np.resize(_COVERED, len(data)))
    samples = samples[samples + depth + 8 <= len(data)]
    rank = np.zeros(len(data), np.int32)
    rank[samples] = cover_ranks(data, samples, depth)
    head = data[suffixes].astype(np.int64) * 256 + data[suffixes + 1]
    sizes = np.bincount(head, minlength=65536)
    part = (np.cumsum(sizes) - 1) // most
    for p in np.unique(part[sizes > 0]):
        yield _sort_bucket(word, rank, suffixes[part[head] == p])


def _sort_bucket(word: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    one, two = word[at].astype(np.uint64), word[at + 8].astype(np.uint64)
    order = np.lexsort((two, one))
    at = at[order]
    group = np.cumsum(run_starts(one[order]) | run_starts(two[order])) - 1
    place = np.arange(len(at))  # where the suffixes of still open groups go
    done = at.copy()
    while True:  # part every open group by its first member: before it, tied with it, behind it
        keep = (np.bincount(group) > 1)[group]
        at, group, place = at[keep], group[keep], place[keep]
        if not len(at):
            return done
        first = run_starts(group)
        pivot = at[first][np.cumsum(first) - 1]
        shift = _SHIFT[at % PERIOD, pivot % PERIOD]
        side = np.sign(rank[at + shift] - rank[pivot + shift])
        order = np.lexsort((side, group))
        at, side, group = at[order], side[order], group[order]
        done[place] = at
        group = np.cumsum(run_starts(group) | run_starts(side)) - 1
        open_ = side != 0  # those tied with the pivot are equal
        if not open_.any():
            return done
        at, place = at[open_], place[open_]
        group = np.cumsum(run_starts(group[open_])) - 1


def equal_to_previous(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether each of the sorted suffixes shares its first ``length`` bytes with the one before."""
    word = lanes(data, "<")
    same = np.zeros(len(at), bool)
    same[1:] = True
    for step in (*range(0, length - 8, 8), length - 8):
        value = word[at + step]
        same[1:] &= value[1:] == value[:-1]
    return same


def late_windows(rows: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For rows ``[size, bytes...]`` of a bucket: which of their windows also stand in a row of a smaller document."""
    whole, width = rows.tobytes(), rows.shape[1]
    seen: dict[bytes, int] = {}
    of = np.array([seen.setdefault(whole[i:i + width], len(seen)) for i in range(0, len(whole), width)], np.int64)
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    different = np.frombuffer(b"".join(seen), np.uint8).reshape(-1, width)
    late = _late(different, least, length)[of] | (doc > least[of])[:, None]
    return late & (np.arange(width - length) < (rows[:, :1].astype(np.int64) - length + 1))


def _late(rows: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    n, most = len(rows), rows.shape[1] - length
    text = np.zeros((n + 2, STRIDE), np.uint8)
    text[:n, :rows.shape[1] - 1] = rows[:, 1:]
    data = text.ravel()
    counts = rows[:, 0].astype(np.int64) - length + 1
    row = np.repeat(np.arange(n), counts)
    column = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    late = np.zeros((n, most), bool)
    for at in sorted_blocks(data, row * STRIDE + column, length):
        run = np.cumsum(~equal_to_previous(data, at, length)) - 1
        own = doc[at // STRIDE]
        least = np.minimum.reduceat(own, np.flatnonzero(run_starts(run)))
        late[at // STRIDE, at % STRIDE] = own > least[run]
    return late


class Snippets:
    """What a chunk sends to the suffix buckets: its distinct runs of windows whose anchors other texts share."""

    def __init__(self, texts: Texts, anchors: Anchors, flags: Callable[[np.ndarray], np.ndarray], length: int, buckets: int):
        gram, where, _ = grouped(anchors.gram)
        self.flags = flags(gram)  # of each gram: in several chunks, in many places
        shared, hot = self.flags.T
        runs = np.flatnonzero((shared | shared_inside(anchors, where, len(gram)))[where])
        single = np.where(hot[where[runs]], anchors.count[runs], 1)  # windows of hot anchors go one by one
        owner = np.repeat(runs, single)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(single) - single, single)
        alone = np.repeat(hot[where[runs]], single) if len(runs) else np.zeros(0, bool)
        self.first = anchors.first[owner] + step
        self.count = np.where(alone, 1, anchors.count[owner])
        self.doc = anchors.doc[owner]
        whole = texts.bytes.tobytes()
        seen: dict[bytes, int] = {}
        self.of = np.array([seen.setdefault(whole[a:a + c + length - 1], len(seen)) for a, c in zip(self.first.tolist(), self.count.tolist())], np.int64)
        lead = np.flatnonzero(run_starts(np.sort(self.of))) if len(self.of) else np.zeros(0, np.int64)
        order = np.argsort(self.of, kind="stable")[lead]  # texts are in document order: the first occurrence has the least id
        self.lead = order
        self.least = texts.doc[self.doc[order]]
        text = np.zeros((len(order), 2 * length - GRAM + 1), np.uint8)
        text[:, 0] = self.count[order] + length - 1
        for lo in range(0, len(order), ROWS):
            part = text[lo:lo + ROWS]
            reach = np.minimum(self.first[order[lo:lo + ROWS], None] + np.arange(text.shape[1] - 1), len(texts.bytes) - 1)
            part[:, 1:] = np.where(np.arange(text.shape[1] - 1) < part[:, :1], texts.bytes[reach], 0)
        self.rows = text
        tail = lanes(np.ascontiguousarray(text[:, 1:]).ravel(), "<") if len(text) else np.zeros(0, np.uint64)
        own = np.zeros(len(text), np.uint64)
        for at in (*range(0, length - 8, 8), length - 8) if len(text) else ():
            own = mix64(own ^ tail[np.arange(len(text)) * (text.shape[1] - 1) + at])
        self.bucket = np.where(alone[order], (own % np.uint64(buckets)).astype(np.int32), bucket_of(anchors.gram[owner[order]], buckets))


def bucket_of(gram: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(gram) % np.uint64(buckets)).astype(np.int32)


def shared_inside(anchors: Anchors, where: np.ndarray, n: int) -> np.ndarray:
    """Whether each gram stands in two texts of the chunk with different indexes."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, where, anchors.doc)
    np.maximum.at(high, where, anchors.doc)
    return low < high


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, spans, kept)``: every text's UTF-8 bytes without those that a ``length``-byte string
    covers which also starts in a document with a smaller id, judged on the input.

    Windows of texts are dealt to buckets of suffixes by their anchors: a first exchange finds the anchors
    that two documents share, a second sends the bytes around them, each distinct run once per chunk. A
    bucket sorts its suffixes blockwise with a difference cover sample, and equal neighbours show which
    windows an earlier document holds. An anchor with many occurrences sends its windows to buckets of
    their own, so that no bucket gathers all surroundings of a common passage.

    ``spans`` are the maximal removed runs as ``(start, end)``, ``kept`` the other bytes. Null and empty
    texts have none. A null id comes before all ids; rows with the same id are one document, which takes
    nothing from itself. Other columns are not looked at. No rows: no rows. 32 <= length <= 51.

    ``docs`` is read anew by each of three passes, of which the first two leave bits only, so that the anchors'
    exchange is gone before the windows' is made: its rows must be the same each time.
    """
    if not 32 <= length <= 51:
        raise ValueError("length must be 32 to 51")
    ship(docs.sparkSession)
    dealt, n = chunked(docs, id_col, text_col, CHUNK)
    windows = length - GRAM + 1
    width = 2 * length - GRAM + 1

    def send_anchors(rows: pa.Table) -> pa.Table:
        anchors = Anchors(Texts(rows), length)
        gram, _, times = grouped(anchors.gram)
        data = np.concatenate([gram.view(np.uint8).reshape(-1, 8), np.minimum(times, 255).astype(np.uint8)[:, None]], axis=1)
        return pack(rows.column("chunk")[0].as_py(), bucket_of(gram, n), np.zeros(len(gram), np.int64), data)

    def judge_anchors(data: np.ndarray, _doc: np.ndarray, _sizes: list[int]) -> np.ndarray:
        key = np.ascontiguousarray(data[:, :8]).view(np.uint64).ravel()
        _, run, chunks = grouped(key)
        times = np.bincount(run, data[:, 8])
        return np.stack([chunks[run] > 1, times[run] >= HOT], axis=1)

    def send_snippets(_key: tuple[pa.Scalar, ...], rows: pa.Table, marks: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pack(0, np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, width), np.uint8))
        texts, chunk = Texts(rows), rows.column("chunk")[0].as_py()
        sent = Snippets(texts, Anchors(texts, length), lambda gram: returned(marks, bucket_of(gram, n), 2), length, n)
        order = np.argsort(sent.least, kind="stable")
        packets = pack(chunk, sent.bucket[order], sent.least[order], sent.rows[order])
        return with_note(packets, chunk, np.packbits(sent.flags).tobytes())  # the flags come back to the chunk as they are

    def judge_snippets(rows: pa.Table) -> pa.Table:
        return judged(rows, lambda data, doc, _: late_windows(data, doc, length), width, windows)

    def finish(_key: tuple[pa.Scalar, ...], rows: pa.Table, marks: pa.Table) -> pa.Table:
        texts = Texts(rows)
        marks, note = split_note(marks)
        sent = Snippets(texts, Anchors(texts, length), lambda gram: np.unpackbits(np.frombuffer(note, np.uint8), count=2 * len(gram)).astype(bool).reshape(-1, 2), length, n)
        order = np.argsort(sent.least, kind="stable")
        late = np.zeros((len(order), windows), bool)
        late[order] = returned(marks, sent.bucket[order], windows)
        late = late[sent.of] | (texts.doc[sent.doc] > sent.least[sent.of])[:, None]
        late &= np.arange(windows) < sent.count[:, None]
        run, column = np.nonzero(late)
        at = sent.first[run] + column
        edge = np.zeros(texts.size + length + 1, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        gone = np.cumsum(edge[:texts.size]) > 0
        spans, kept = [], []
        for text, a, b in zip(texts.texts, texts.starts, texts.ends):
            own = gone[a:b]
            if own.any():
                turn = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
                spans.append([{"start": int(s), "end": int(e)} for s, e in turn.reshape(-1, 2)])
                kept.append(np.frombuffer(text, np.uint8)[~own].tobytes())
            else:
                spans.append([])
                kept.append(text)
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        sizes = pa.array(texts.ends - texts.starts, pa.int64())
        return pa.table([texts.ids(), sizes, pa.array(spans, kinds), pa.array(kept, pa.binary())], names=["doc", "n_bytes", "spans", "kept"])

    def judge_grams(rows: pa.Table) -> pa.Table:
        return judged(rows, judge_anchors, 9, 2)

    anchors = dealt.groupBy("chunk").applyInArrow(send_anchors, PACKED)
    shared = settle(anchors.groupBy("bucket").applyInArrow(judge_grams, JUDGED), "anchors")
    snippets = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(send_snippets, PACKED)
    late = settle(snippets.groupBy("bucket").applyInArrow(judge_snippets, JUDGED), "windows")
    done = dealt.groupBy("chunk").cogroup(late.groupBy("chunk")).applyInArrow(
        finish, "doc long, n_bytes long, spans array<struct<start long, end long>>, kept binary"
    )
    return done.select(F.col("doc").alias(id_col), "n_bytes", "spans", "kept")
