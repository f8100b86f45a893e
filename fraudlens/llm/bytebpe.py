"""Byte-level BPE encoding and decoding with exact merges in linear time (operator 8)."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import in_chunks, ship

CHUNK = 1 << 20  # characters of text that a task holds at once
CACHED = 200_000  # pieces in each of the two generations of a worker's cache
CACHED_LENGTH = 48
FITS = 1 << 18  # borders between tokens that a codec remembers
LONG = 1 << 20  # beyond so many characters a text is split lazily


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode defines it, as the reference library reads it."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


# What classes of the pattern mean in ASCII text, inside and outside of brackets
_ASCII = {r"\p{L}": ("A-Za-z", "[A-Za-z]"), r"\p{N}": ("0-9", "[0-9]"), r"\s": (r"\t-\r ", r"[\t-\r ]"), r"\S": (None, r"[^\t-\r ]")}


def ascii_splitter(pattern: str) -> re.Pattern | None:
    """The same pattern for ASCII texts, which the plain module matches faster; None if it has other classes."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((n for n in _ASCII if pattern.startswith(n, at)), pattern[at])
        if name == "\\" or name in _ASCII and inside and _ASCII[name][0] is None or pattern.startswith(("(?i", "++", "*+", "?+"), at):
            return None
        out.append(_ASCII[name][not inside] if name in _ASCII else name)
        inside = name == "[" or inside and name != "]"
        at += len(name)
    return re.compile("".join(out))


class Codec:
    """Encoder and decoder of one vocabulary; ranks are ids and give the order of merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.halves = {rank: self._last_merge(token, rank) for token, rank in ranks.items()}
        # tokens that merges never produce are used for whole pieces only
        self.made = {t: r for t, r in ranks.items() if len(t) == 1 or self.halves[r]}
        self.whole = {halves: rank for rank, halves in self.halves.items() if halves}
        self.shorter = {r: next((self.made[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.made), None) for t, r in self.made.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.most = max(map(len, self.made), default=0)
        self.base = max(ranks.values(), default=0) + 1
        self.fits: dict[int, int | None] = {}  # what ``behind`` found, by left * base + token
        self.finder = ahocorasick.Automaton()
        for token, rank in self.made.items():
            self.finder.add_word(token.decode("latin-1"), rank)
        self.finder.make_automaton()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one, None for bytes and for tokens no merges make."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(((self.ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best >= rank:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merges leave a border between these two tokens."""
        return self.behind(left, right) == right

    def behind(self, left: int, token: int) -> int | None:
        """The longest token that begins ``token``, itself included, and may stand behind ``left``; memoised."""
        tried, found = [], token
        while found is not None:
            border = left * self.base + found
            if border in self.fits:
                found = self.fits[border]
                break
            tried.append(border)
            if self._border_stays(left, found):
                break
            found = self.shorter[found]
        if len(self.fits) > FITS:
            self.fits.clear()
        self.fits.update(dict.fromkeys(tried, found))
        return found

    def _border_stays(self, left: int, right: int) -> bool:
        """Undo merges at the border, latest first, and see whether an earlier merge would have crossed it."""
        halves, before = self.halves, len(self.ranks) + 1
        undo_left, undo_right = halves[left], halves[right]
        while True:
            crossing = self.whole.get((left, right))
            if crossing is not None and crossing < before:
                return False
            if undo_left is None and undo_right is None:
                return True
            # of two equal merges the left one happens first, so the right one is undone first
            if undo_right is None or undo_left is not None and left > right:
                before, left = left, undo_left[1]
                undo_left = halves[left]
            else:
                before, right = right + 1, undo_right[0]
                undo_right = halves[right]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, as repeated merging of the lowest-ranked adjacent pair gives them."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        text, ids, fits, base, before = piece.decode("latin-1"), [], self.fits, self.base, None
        for end, token in self.finder.iter_long(text):  # longest matches, one after the other
            if before is not None:
                border = before * base + token
                if (fits[border] if border in fits else self.behind(before, token)) != token:
                    return self._backtrack(text, ids, end + 1 - self.size[token], token)
            ids.append(token)
            before = token
        return ids

    def _longest(self, text: str, at: int) -> int | None:
        """The longest token that begins at this place, found by walking down the automaton's trie."""
        ahead = text[at:at + self.most]
        find = self.finder.get
        for n in range(self.finder.longest_prefix(ahead), 0, -1):
            token = find(ahead[:n], None)
            if token is not None:
                return token
        return None

    def _backtrack(self, text: str, ids: list[int], at: int, token: int | None) -> list[int]:
        """Go on behind ``ids``, where the longest match ``token`` does not fit. Only places that are come to are
        looked at."""
        size, shorter, fits, base, stop = self.size, self.shorter, self.fits, self.base, len(text)
        dead: set[int] = set()
        while True:
            while token is not None:
                if ids:
                    border = ids[-1] * base + token
                    token = fits[border] if border in fits else self.behind(ids[-1], token)
                    if token is None:
                        break
                if at + size[token] not in dead:
                    break
                token = shorter[token]
            if token is None:  # no way on from here: give up the last token for a shorter one
                dead.add(at)
                last = ids.pop()
                at -= size[last]
                token = shorter[last]
            else:
                ids.append(token)
                at += size[token]
                if at >= stop:
                    return ids
                token = self._longest(text, at)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_packed(self, ids: bytes) -> bytes:
        return self.decode(np.frombuffer(ids, np.int32).tolist())


class Encoder:
    """A codec with a bounded cache of the packed ids of pieces."""

    def __init__(self, codec: Codec, pattern: str):
        self.codec, self.split, self.plain = codec, splitter(pattern), ascii_splitter(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _miss(self, piece: str) -> bytes:
        made = self.old.get(piece)
        if made is None:
            made = array("i", self.codec.encode_piece(piece.encode())).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[piece] = made
        return made

    def __call__(self, text: str) -> tuple[bytes, bytes]:
        """Packed ids of a text, and the bytes that they decode to."""
        split = self.plain if self.plain is not None and text.isascii() else self.split
        if len(text) <= LONG:
            ids = b"".join(self._look_up(split.findall(text)))
            return ids, self.codec.decode_packed(ids)
        ids, decoded = bytearray(), bytearray()
        found = (m.group() for m in split.finditer(text))
        while part := list(islice(found, 100_000)):
            packed = b"".join(self._look_up(part))
            ids += packed
            decoded += self.codec.decode_packed(packed)
        return bytes(ids), bytes(decoded)

    def _look_up(self, found: list[str]) -> list[bytes]:
        made = list(map(self.young.get, found))
        at = -1
        for _ in range(made.count(None)):
            at = made.index(None, at + 1)
            made[at] = self.young.get(found[at]) or self._miss(found[at])
        return made


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def worker_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this Python worker, built once for each vocabulary."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(Codec(read_ranks(path)), pattern)
    return _ENCODERS[path, pattern]


def encode_documents(
    docs: DataFrame, locate: Callable[[], str], pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, ids array<int>, decoded binary)`` of every whole text; null and empty texts have no ids.

    ``locate`` is called on the worker and gives the vocabulary file's path there. ``pattern`` cuts a text
    into pieces that are encoded one by one; what no match covers is left out, as the reference library
    does. ``decoded`` is made from the ids. No shuffle; other columns are not looked at; repeated rows
    are encoded one by one; an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(locate(), pattern)
        for batch in batches:
            rows = ((i.as_py(), t.as_py()) for i, t in zip(batch.column(0), batch.column(1)))  # not all of a batch at once
            for part in in_chunks(rows, lambda r: len(r[1] or ""), CHUNK):
                made = [encoder(text or "") for _, text in part]
                ends = np.cumsum([0, *(len(m[0]) // 4 for m in made)], dtype=np.int32)
                ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join([m[0] for m in made]))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in part], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
                        pa.array([m[1] for m in made], pa.binary()),
                    ],
                    ["id", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token counts and digests of encoded documents."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
