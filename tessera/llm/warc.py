"""Operator 13: WARC archives in Zstandard files, written and read by tasks.

A record is one Zstandard frame (with content size and checksum).  An archive begins
with a skippable frame that holds the dictionary its frames were compressed with;
a task trains it on the first ``SAMPLE`` bytes of its own records and goes without
where they are too few.  Spark's text writer puts each archive into a file of its
own, with an empty skippable frame as line end, so any file system that Spark
writes to will do, and a lost task's files are never committed.

Of records with equal payloads (compared by SHA-256) the smallest page_id is the
``response``, the others are ``revisit`` records that name it and keep only the HTTP
head, with the full payload's length and digest.  Groups of equal payloads are found
on digests alone and only those of two rows or more are joined back: the ones with
more rows than an even share of a partition, fewer than there are partitions, by
broadcast; the others by Spark's choice.  Payloads aren't shuffled for the former.

The reader loads the dictionary, decodes frame by frame, and checks each record: the
version line, the mandatory headers, that ``Content-Length`` covers the block and the
frame ends with it, the HTTP head, the payload's length, and its SHA-1.  A file that
fails raises, or gives a row with ``error`` where ``strict`` is off.

Cases: a null payload is empty; a null url has no target header, control characters
and blanks of another are percent-encoded; rows that share the smallest page_id of
their payload are all responses; a row without page_id revisits the smallest, or is a
response where all are null; a record larger than an archive has one alone, and takes
memory in proportion; an empty table writes no record; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import shared_path
from .running import lookup
from .textbatch import map_batches
from .written import written

#: compressed bytes after which an archive is closed
ARCHIVE = 32 << 20
SAMPLE, DICTIONARY = 1 << 20, 32 << 10
LEVEL = 3
# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_MAGIC = 0xEC30A437
FRAME = 0xFD2FB528
LINE_END = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-record-id", "content-length", "warc-date", "warc-type")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
URN = "urn:x-page:"


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name(page_id: int | None) -> str:
    return f"<{URN}{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """The bytes of a response, or of a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    again = first is not None and first != page_id
    block = http if again else http + payload
    head = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", "sha1:" + sha1(payload)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    if url is not None:
        head.insert(2, ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if again:
        head += [("WARC-Refers-To", name(first)), ("WARC-Profile", PROFILE)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        key = k.decode().lower()
        if not colon or not key or key != key.strip() or key in out:
            raise ValueError(f"bad header line {line[:80]!r}")
        out[key] = v.decode().strip()
    return out


def number(text: str) -> int:
    if not re.fullmatch(r"[0-9]+", text):
        raise ValueError(f"bad length {text!r}")
    return int(text)


def urn(text: str) -> str:
    if not text.startswith("<") or not text.endswith(">"):
        raise ValueError(f"bad id {text!r}")
    return text[1:-1]


def parse(data: bytes) -> dict:
    """The fields of the one record that ``data`` holds; raises ValueError where
    headers, lengths or digests don't hold."""
    head, end, rest = data.partition(b"\r\n\r\n")
    if not end or head.split(b"\r\n", 1)[0] not in VERSIONS:
        raise ValueError("no record head")
    h = fields(head)
    for k in MANDATORY:
        if k not in h:
            raise ValueError(f"no {k}")
    n = number(h["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"block of {n} bytes doesn't end its frame")
    block, kind = rest[:n], h["warc-type"]
    out = {"record_id": urn(h["warc-record-id"]), "record_type": kind, "target_uri": h.get("warc-target-uri"), "refers_to": None,
           "payload_bytes": n, "payload_digest": None, "payload": block}
    digest = h.get("warc-payload-digest")
    if digest is not None:
        if not digest.startswith("sha1:"):
            raise ValueError(f"unknown digest {digest!r}")
        out["payload_digest"] = digest[5:]
    if kind not in ("response", "revisit"):
        return out
    top, end, payload = block.partition(b"\r\n\r\n")
    if not end or not top.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    http = fields(top)
    size = number(http["content-length"]) if "content-length" in http else len(payload)
    if kind == "response":
        if size != len(payload) or digest is not None and digest[5:] != sha1(payload):
            raise ValueError("payload doesn't match its length or digest")
        return out | {"payload_bytes": size, "payload": payload}
    if payload or digest is None or "warc-refers-to" not in h:
        raise ValueError("a revisit has a digest, a reference and no payload")
    return out | {"payload_bytes": size, "payload": None, "refers_to": urn(h["warc-refers-to"])}


def trained(samples: list[bytes]):
    """A dictionary of these records, or None where they are too few."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY, samples)
    except zstandard.ZstdError:
        return None


def archives(records: Iterator[bytes], limit: int = ARCHIVE) -> Iterator[bytes]:
    """Whole archives of the given records."""
    import zstandard
    held, size, state = [], 0, None

    def start():
        samples = held if sum(map(len, held)) <= 2 * SAMPLE else [x[:SAMPLE // len(held)] for x in held]
        d = trained(samples) if held else None
        if d:
            d.precompute_compress(level=LEVEL)
        lead = b"" if d is None else struct.pack("<II", DICTIONARY_FRAME, len(d)) + d.as_bytes()
        return lead, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=True, write_content_size=True)

    def packed():
        nonlocal held, size, state
        for r in records:
            if state is None:
                held.append(r)
                size += len(r)
                if size < SAMPLE:
                    continue
                state, ready, held = start(), held, []
            else:
                ready = (r,)
            for x in ready:
                yield state[1].compress(x)
        if state is None and held:
            state = start()
            for x in held:
                yield state[1].compress(x)
    out = bytearray()
    for frame in packed():
        if not out:
            out += state[0]
        out += frame
        if len(out) >= limit:
            yield bytes(out)
            out = bytearray()
    if out:
        yield bytes(out)


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, by the dictionary of its leading frame."""
    import zstandard
    at, plain = 0, zstandard.ZstdDecompressor()
    d = plain
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("truncated frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(data):
                raise ValueError("truncated skippable frame")
            if magic == DICTIONARY_FRAME and at == 0:
                words = data[8:8 + size]
                if words[:4] == struct.pack("<I", FRAME):
                    words = plain.decompress(words)
                if words[:4] != struct.pack("<I", DICTIONARY_MAGIC):
                    raise ValueError("the leading frame holds no dictionary")
                d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
            at += 8 + size
            continue
        if magic != FRAME:
            raise ValueError(f"no frame at byte {at}")
        one, parts = d.decompressobj(), []
        try:
            size = zstandard.frame_content_size(data[at:at + 18])
            while not one.eof:
                piece = data[at:at + (1 << 16)]
                if not piece:
                    raise ValueError("truncated frame")
                parts.append(one.decompress(piece))
                at += len(piece)
        except zstandard.ZstdError as e:
            raise ValueError(str(e)) from None
        at -= len(one.unused_data)
        out = b"".join(parts)
        if size not in (-1, len(out)):
            raise ValueError("a frame's content has another length than it states")
        yield out


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, limit: int = ARCHIVE) -> None:
    """Write rows (page_id, url, html) as records of archives below ``path``; equal
    payloads of at least ``min_bytes`` bytes are stored once."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    same = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
            .filter("n > 1 AND first IS NOT NULL"))
    same = written(same, "warc-equal")
    share = pages.count() / parts
    # fewer groups than partitions can hold more rows than an even share
    found = lookup(rows, "key", same, "key", "first", F.col("n") > share)

    def run(batches):
        def records():
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    yield record(*row)
        for a in archives(records(), limit):
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.binary())], ["archive"])
    (found.select("page_id", "url", "payload", "first").mapInArrow(run, "archive binary")
     .select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", LINE_END).text(path))


RECORD = {"record_id": pa.string(), "record_type": pa.string(), "target_uri": pa.string(), "refers_to": pa.string(), "payload_bytes": pa.int64(),
          "payload_digest": pa.string(), "payload": pa.binary(), "error": pa.string()}


def read_archives(spark: SparkSession, path: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """The records of the archives below ``path``; without ``strict`` what can't be
    read gives a row with ``error``, and the rest of a broken file is left out."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out: list[dict] = []
        for file, data in zip(b.column(0).to_pylist(), b.column(1)):
            try:
                for x in frames(data.as_buffer().to_pybytes()):
                    try:
                        out.append(parse(x) | ({} if payloads else {"payload": None}))
                    except (ValueError, UnicodeDecodeError) as e:
                        out.append({"error": f"{file}: {e}"})
            except ValueError as e:
                out.append({"error": f"{file}: {e}"})
            if strict and out and any(x.get("error") for x in out):
                raise ValueError(next(x["error"] for x in out if x.get("error")))
        return pa.RecordBatch.from_arrays([pa.array([x.get(k) for x in out], t) for k, t in RECORD.items()], list(RECORD))
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_batches(files, run, "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, "
                                   "payload_digest string, payload binary, error string")


def page(col: str):
    """The page_id in a record's id; null for the record of a null one."""
    return F.expr(f"try_cast(substring({col}, {len(URN) + 1}) AS bigint)")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read
    back from the archives written for it."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    got = read_archives(pages.sparkSession, path, payloads=False)
    return got.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS low FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN low IS NULL OR page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM low THEN low END AS refers_to
FROM d
"""
