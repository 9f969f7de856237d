"""Operator 5: token ids in patched frame-of-reference blocks.

Ids are cut into blocks of ``BLOCK`` values.  A block stores its minimum and
the differences to it, packed with the smallest width that holds
``PERCENTILE`` percent of them; the high bits of the others go to an exception
list (position, high bits).  64 packed values take exactly ``width`` 64-bit
words, so every block has a known place and the header indexes block starts.

A *segment* is one such byte string for a run of whole documents, and one row
of a shard file (Parquet), with the documents and their lengths beside it.
Shards are range partitions by doc_id, written by their tasks; a small index
table gives each shard's number of ids, and its running sum the position of
every document in the whole sequence.  A lost executor repeats its shards; the
committed files are read back by any task.

Cases: null or empty text holds the end id alone; a document longer than a
segment is a segment of its own; equal doc_ids lie side by side, ordered by
text; null doc_ids come first; an empty table writes no shard and reads back
empty; further columns are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import shared_path
from . import segments
from .textbatch import map_batches

BLOCK = 1024
PERCENTILE = 98
SEGMENT_IDS = 1 << 16
_MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sQII")  # magic, ids, blocks, exceptions


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """[n, 64] values below 2^w -> [n, w] words."""
    out = np.zeros((len(v), w), np.uint64)
    for j in range(64):
        k, s = divmod(j * w, 64)
        out[:, k] |= v[:, j] << np.uint64(s)
        if s + w > 64:
            out[:, k + 1] |= v[:, j] >> np.uint64(64 - s)
    return out


def _unpack(x: np.ndarray, w: int) -> np.ndarray:
    out = np.empty((len(x), 64), np.uint64)
    mask = np.uint64((1 << w) - 1)
    for j in range(64):
        k, s = divmod(j * w, 64)
        v = x[:, k] >> np.uint64(s)
        if s + w > 64:
            v = v | (x[:, k + 1] << np.uint64(64 - s))
        out[:, j] = v & mask
    return out


def pack_ids(ids: np.ndarray) -> bytes:
    """The byte string of a segment of unsigned 32-bit ids."""
    n = len(ids)
    nb = -(-n // BLOCK)
    v = np.zeros(nb * BLOCK, np.uint64)
    v[:n] = ids
    if n:
        v[n:] = v[n - 1]
    v = v.reshape(nb, BLOCK)
    low = v.min(axis=1, initial=0xFFFFFFFF) if nb else np.zeros(0, np.uint64)
    d = v - low[:, None]
    at = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    cut = np.partition(d, at, axis=1)[:, at].tolist() if nb else []
    width = np.array([int(x).bit_length() for x in cut], np.uint8)
    start = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 64) * 8)]).astype("<u8")
    body = np.zeros(int(start[-1]) // 8, "<u8")
    high = d >> width.astype(np.uint64)[:, None]
    bi, pos = np.nonzero(high)
    for w in np.unique(width).tolist():
        if w:
            b = np.flatnonzero(width == w)
            packed = _pack((d[b] & np.uint64((1 << w) - 1)).reshape(-1, 64), w).reshape(len(b), -1)
            body[(start[b] // np.uint64(8)).astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    return b"".join([_HEAD.pack(_MAGIC, n, nb, len(bi)), low.astype("<u4").tobytes(), width.tobytes(), start.tobytes(),
                     (bi * BLOCK + pos).astype("<u8").tobytes(), high[bi, pos].astype("<u4").tobytes(), body.tobytes()])


def unpack_ids(data: bytes) -> np.ndarray:
    """The ids of a segment, as little-endian uint32."""
    magic, n, nb, ne = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a segment")
    o = _HEAD.size

    def take(kind: str, k: int) -> np.ndarray:
        nonlocal o
        a = np.frombuffer(data, kind, k, o)
        o += a.nbytes
        return a
    low, width, start, where, high = take("<u4", nb), take("u1", nb), take("<u8", nb + 1), take("<u8", ne), take("<u4", ne)
    body = take("<u8", int(start[-1]) // 8 if nb else 0)
    out = np.zeros((nb, BLOCK), np.uint64)
    for w in np.unique(width).tolist():
        if w:
            b = np.flatnonzero(width == w)
            words = w * (BLOCK // 64)
            x = body[(start[b] // np.uint64(8)).astype(np.int64)[:, None] + np.arange(words)]
            out[b] = _unpack(x.reshape(-1, w), w).reshape(len(b), BLOCK)
    if ne:
        b = (where // BLOCK).astype(np.int64)
        out.ravel()[where.astype(np.int64)] |= high.astype(np.uint64) << width[b].astype(np.uint64)
    return (out + low[:, None].astype(np.uint64)).ravel()[:n].astype("<u4")


# -- tokens ------------------------------------------------------------------
_STATE: dict[str, "LibraryEncoder"] = {}


class LibraryEncoder:
    """The tokenizers library behind a memory of segments; special strings in a
    text are handled as the library does by default."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tk = Tokenizer.from_file(path)
        self.special = [a.content for a in self.tk.get_added_tokens_decoder().values()]
        # a byte-level vocabulary writes each byte as one character: the first 256
        # characters by the library's own table
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {b: level.pre_tokenize_str(chr(b))[0][0][-1] for b in range(0x20, 0x7F)}
        for b in range(0x80, 0x100):  # as the last byte of a two- or three-byte character, or the first of one
            text = bytes([0xC3, b]).decode() if b < 0xC0 else chr((b & 0x1F) << 6) if 0xC2 <= b < 0xE0 else ""
            if text:
                self.written[b] = level.pre_tokenize_str(text)[0][0][-1 if b < 0xC0 else 0]
        self.memory = segments.Memory(self.encode)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """ids of segments.  One of Latin letters, after a space or not, is a single
        pre-token and goes to the library's model directly."""
        out: list = [None] * len(texts)
        rest, tokenize, written = [], self.tk.model.tokenize, self.written
        for i, t in enumerate(texts):
            if (t[1:] if t[0] == " " else t).isalpha() and max(t) < "\u0250":
                out[i] = [x.id for x in tokenize(t.encode().decode("latin-1").translate(written))]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tk.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def column(self, col: pa.Array):
        """ids of each text of a column; a special string may stand anywhere in a
        text, and such texts are encoded whole."""
        odd = pa.array(np.zeros(len(col), bool))
        for s in self.special:
            odd = pc.or_(odd, pc.fill_null(pc.match_substring(col, s), False))
        if pc.any(odd).as_py():
            plain = segments.encoded(self.memory, pc.if_else(odd, "", col))
            for t, o, ids in zip(col, odd, plain):
                yield np.array(self.tk.encode(t.as_py(), add_special_tokens=False).ids, np.uint32) if o.as_py() else ids
        else:
            yield from segments.encoded(self.memory, col)


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _STATE:
        _STATE[path] = LibraryEncoder(path)
    return _STATE[path]


# -- files -------------------------------------------------------------------
SEGMENTS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_lens", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType())])


def write_ids(df: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode rows (doc_id, text) and write shards below ``path`` in ascending
    doc_id order, ``end_id`` after each document."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        from pyspark import TaskContext
        shard, first = TaskContext.get().partitionId(), 0
        docs, parts, held = [], [], 0
        end = np.array([end_id], np.uint32)
        enc = library_encoder(tokenizer)

        def flush():
            nonlocal first, docs, parts, held
            lens = [len(p) + 1 for p in parts]
            row = [shard], [first], [held], [docs], [lens], [pack_ids(np.concatenate([x for p in parts for x in (p, end)]))]
            first, docs, parts, held = first + held, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, (
                pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))], SEGMENTS.names)
        for b in batches:
            for d, ids in zip(b.column(0).to_pylist(), enc.column(b.column(1))):
                docs.append(d)
                parts.append(ids)
                held += len(ids) + 1
                if held >= SEGMENT_IDS:
                    yield flush()
        if docs:
            yield flush()
    (df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SEGMENTS).write.option("compression", "uncompressed").parquet(path))


def read_ids(spark, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids."""
    seg = spark.read.schema(SEGMENTS).parquet(path)
    # one row per shard, as many as the write had tasks
    sizes = sorted((r.shard, r.n) for r in seg.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    before, total = [], 0
    for s, k in sizes:
        before.append((s, total))
        total += k
    base = spark.createDataFrame(before, "shard int, base long")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], []]
        for base_, first, docs, lens, data in zip(*(b.column(i).to_pylist() for i in range(5))):
            ids, at = unpack_ids(data), 0
            for d, k in zip(docs, lens):
                for c, v in zip(cols, (d, base_ + first + at, k, ids[at:at + k].tobytes())):
                    c.append(v)
                at += k
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                          ["doc_id", "start", "n_tokens", "ids"])
    rows = seg.join(F.broadcast(base), "shard").select("base", "first", "doc_ids", "doc_lens", "payload")
    return map_batches(rows, run, "doc_id long, start long, n_tokens long, ids binary")


def ids_round_trip(df: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the written files."""
    path = shared_path(df.sparkSession, "token-ids")
    write_ids(df, path, tokenizer, end_id)
    return read_ids(df.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
