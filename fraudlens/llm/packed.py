"""Exchange of many small values between texts and buckets, as packed arrays.

Documents are dealt into chunks by a hash of their id, once. A chunk sends each bucket one row of packed
values; the bucket judges them and sends one row of bits back; the chunk, which is read again from
the same exchange, applies them. What is sent twice from a chunk can be joined before sending, so a
value that a third of all rows holds reaches its bucket once per chunk at most.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import partitions

SHARE = 2  # chunks and buckets per shuffle partition
PACKED = "bucket int, chunk int, data binary, docs binary, counts binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary())])
JUDGED = "chunk int, bucket int, bits binary"
_JUDGED = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
NOTE = -1  # in the place of a bucket: what a chunk has sent to itself
NO_ID = np.iinfo(np.int64).min  # a null id, before all others


def chunked(docs: DataFrame, id_col: str, text_col: str, most: int | None = None) -> tuple[DataFrame, int]:
    """``(chunk, doc, text)`` dealt by chunk, and the number of chunks: enough to hold ``most`` bytes of text each."""
    n = SHARE * partitions(docs.sparkSession)
    if most:
        n = max(n, -(-(docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0) // most))
    chunk = F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int").alias("chunk")
    return docs.select(chunk, F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).repartition("chunk"), n


class Texts:
    """The texts of a chunk in document order, as one byte array."""

    def __init__(self, rows: pa.Table, pad: int = 64):
        doc = pc.fill_null(rows.column("doc"), int(NO_ID)).to_numpy()
        text = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks)
        self.null_id = rows.column("doc").is_null().to_numpy()
        self.order = order = np.lexsort((pc.array_sort_indices(pc.array_sort_indices(text)).to_numpy(), doc))
        self.doc, self.null_id = doc[order], self.null_id[order]
        self.texts: list[bytes] = text.take(pa.array(order)).to_pylist()
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in self.texts], np.int64)
        self.bytes = np.frombuffer(b"".join(self.texts) + b"\0" * pad, np.uint8)
        self.size = int(self.ends[-1]) if len(self.ends) else 0

    def ids(self) -> pa.Array:
        return pa.array(self.doc, pa.int64(), mask=self.null_id)


def pack(chunk: int, bucket: np.ndarray, doc: np.ndarray, data: np.ndarray) -> pa.Table:
    """One row per bucket with the values in ``data`` (2-d bytes, one row per value) and their documents;
    ``doc`` is sorted, and the order of values is kept."""
    order = np.argsort(bucket, kind="stable")
    bucket, doc, data = bucket[order], doc[order], data[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    columns: list[list] = [[], [], [], [], []]
    for a, b in zip(cuts[:-1], cuts[1:]):
        first = np.flatnonzero(np.append(True, doc[a + 1:b] != doc[a:b - 1]))
        ids, counts = doc[a:b][first], np.diff(np.append(first, b - a))
        steps = np.diff(ids, prepend=0)
        small = len(steps) < 2 or (steps[1:].min() >= 0 and steps[1:].max() < 65536)
        head = ids[:1].tobytes()
        packed = b"2" + head + steps[1:].astype(np.uint16).tobytes() if small else b"8" + ids.tobytes()
        columns[0].append(int(bucket[a]))
        columns[1].append(chunk)
        columns[2].append(data[a:b].tobytes())
        columns[3].append(packed)
        columns[4].append(counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes())
    return pa.table([pa.array(c, t.type) for c, t in zip(columns, _PACKED)], schema=_PACKED)


def unpack_docs(docs: bytes, counts: bytes) -> np.ndarray:
    """The document of each value of a packed row."""
    if docs[:1] == b"2":
        first = np.frombuffer(docs[1:9], np.int64)
        ids = np.cumsum(np.append(first, np.frombuffer(docs[9:], np.uint16).astype(np.int64)))
    else:
        ids = np.frombuffer(docs[1:], np.int64)
    kind = np.uint8 if len(counts) == len(ids) else np.uint32
    return np.repeat(ids, np.frombuffer(counts, kind))


def judged(rows: pa.Table, judge: Callable[[np.ndarray, np.ndarray, list[int]], np.ndarray], width: int, bits: int = 1) -> pa.Table:
    """Let ``judge(data, doc, sizes)`` decide on all values of a bucket; ``width`` bytes each, sizes by chunk.

    It returns ``bits`` booleans per value, sent back to the chunks in the order the values came in.
    """
    notes = pc.equal(rows.column("docs"), b"")
    back = rows.filter(notes)
    rows = rows.filter(pc.invert(notes))
    note = pa.table([back.column("chunk"), pa.array([NOTE] * back.num_rows, pa.int32()), back.column("data")], schema=_JUDGED)
    if not rows.num_rows:
        return note
    data = [np.frombuffer(d, np.uint8).reshape(-1, width) for d in rows.column("data").to_pylist()]
    doc = [unpack_docs(d, c) for d, c in zip(rows.column("docs").to_pylist(), rows.column("counts").to_pylist())]
    sizes = [len(d) for d in data]
    found = judge(np.concatenate(data), np.concatenate(doc), sizes).reshape(-1, bits)
    cuts = np.cumsum(sizes)[:-1]
    packed = [np.packbits(part).tobytes() for part in np.split(found, cuts)]
    return pa.concat_tables([note, pa.table([rows.column("chunk"), rows.column("bucket"), pa.array(packed, pa.binary())], schema=_JUDGED)])


def with_note(packets: pa.Table, chunk: int, note: bytes) -> pa.Table:
    """The packets and one more that any bucket sends back as it is."""
    return pa.concat_tables([packets, pa.table([pa.array(c, t.type) for c, t in zip(([chunk], [chunk], [note], [b""], [b""]), _PACKED)], schema=_PACKED)])


def split_note(marks: pa.Table) -> tuple[pa.Table, bytes]:
    own = pc.equal(marks.column("bucket"), NOTE)
    return marks.filter(pc.invert(own)), b"".join(marks.filter(own).column("bits").to_pylist())


def returned(rows: pa.Table, bucket: np.ndarray, bits: int = 1) -> np.ndarray:
    """Booleans for the values a chunk has sent, whose buckets are ``bucket``, in the order of sending."""
    found = np.zeros((len(bucket), bits), bool)
    order = np.argsort(bucket, kind="stable")
    of = bucket[order]
    for b, packed in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        lo, hi = np.searchsorted(of, [b, b + 1])
        found[order[lo:hi]] = np.unpackbits(np.frombuffer(packed, np.uint8), count=(hi - lo) * bits).astype(bool).reshape(-1, bits)
    return found
