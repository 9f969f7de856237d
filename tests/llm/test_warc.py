import random
import struct

import pytest
import zstandard

from tessera.llm import warc as W


def brute(rows, least=0):
    out = []
    for d, _, t in rows:
        p = (t or "").encode()
        same = [x for x, _, u in rows if (u or "").encode() == p and x is not None]
        first = min(same) if len(p) >= least and same else None
        again = first is not None and d != first
        out.append((d, len(p), W.sha1(p), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def corpus(seed, n=200):
    r = random.Random(seed)
    texts = ["<html>" + " ".join(r.choice(["para", "été", "日本", "x\r\n\r\ny"]) for _ in range(r.randint(0, 300))) for _ in range(n // 2)]
    rows = [(i * 3, r.choice([None, "http://a.b/ç d\r\nX: y", f"http://h{i}.org/"]), r.choice(texts)) for i in range(n)]
    r.shuffle(rows)
    return rows + [(5000 + i, "u", texts[0]) for i in range(n // 2)] + [(None, None, texts[0]), (None, "u", "alone"), (1, "u", None), (2, "u", ""),
                                                                          (rows[0][0], "again", rows[0][2]), (7, "u", "long " * 100_000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"k", 1) for r in rows], "page_id long, url string, html string, key binary, n int").repartition(5)


@pytest.mark.parametrize("least", [0, 50])
def test_matches_brute_force(spark, least):
    rows = corpus(least)
    got = sorted((tuple(x) for x in W.round_trip(frame(spark, rows), least).collect()), key=repr)
    assert got == brute(rows, least)


def test_many_small_archives_keep_every_payload(spark, tmp_path):
    rows = corpus(3)
    W.write_archives(frame(spark, rows), str(tmp_path / "w"), limit=4000)
    files = [f for f in (tmp_path / "w").glob("part-*") if f.stat().st_size]
    assert len(files) > 5
    got = W.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    by = {r.record_id: r.payload for r in got if r.record_type == "response" and r.record_id != W.URN + "null"}
    for d, _, t in rows:
        if d is not None:
            r = next(x for x in got if x.record_id == f"{W.URN}{d}")
            assert (by[r.refers_to] if r.record_type == "revisit" else r.payload) == (t or "").encode()
    uris = {r.target_uri for r in got}
    assert None in uris and "http://a.b/ç%20d%0D%0AX:%20y" in uris


def test_empty_table(spark):
    assert W.round_trip(frame(spark, [(1, "a", "b")]).limit(0)).collect() == []


def sample(n=400):
    r = random.Random(1)
    return [W.record(i, f"http://x.org/{i}", ("".join(r.choice(["<p>word ", "other</p>", "number %d " % (i % 7)]) for _ in range(150))).encode(), None) for i in range(n)]


def test_dictionary_frame_and_one_frame_a_record():
    records = sample()
    one, = W.archives(iter(records))
    magic, size = struct.unpack_from("<II", one)
    assert magic == W.DICTIONARY_FRAME and one[8:12] == struct.pack("<I", W.DICTIONARY_MAGIC)
    assert list(W.frames(one)) == records
    assert list(W.frames(one + W.LINE_END.encode())) == records
    # a dictionary that is compressed itself
    words = zstandard.ZstdCompressor().compress(one[8:8 + size])
    assert list(W.frames(struct.pack("<II", W.DICTIONARY_FRAME, len(words)) + words + one[8 + size:])) == records
    # without the dictionary the frames can't be read
    with pytest.raises(ValueError):
        list(W.frames(one[8 + size:]))
    # too few records for a dictionary
    few, = W.archives(iter(records[:2]))
    assert struct.unpack_from("<I", few)[0] == W.FRAME and list(W.frames(few)) == records[:2]
    assert list(W.archives(iter([]))) == []


def test_broken_archives_are_found():
    one, = W.archives(iter(sample(50)))
    for bad in (one[:-1], one[:len(one) // 2], one + b"x", one + b"12345678", one[:-3] + bytes([one[-3] ^ 255]) + one[-2:], struct.pack("<II", W.DICTIONARY_FRAME, 10**6) + one[8:]):
        with pytest.raises(ValueError):
            list(W.frames(bad))


@pytest.mark.parametrize("old,new", [
    (b"WARC/1.1", b"WARC/3.0"), (b"WARC-Type: response\r\n", b""), (b"WARC-Date", b"Warc Date "), (b"Content-Length: 5\r\n\r\n", b"Content-Length: 6\r\n\r\n"),
    (b"\r\n\r\nhello", b"\r\n\r\nhallo"), (b"HTTP/1.1", b"GET /"), (b"\r\n\r\nhello\r\n\r\n", b"\r\n\r\nhello\r\n"), (b"<urn:x-page:4>", b"4"),
    (b"hello\r\n\r\n", b"hello\r\n\r\nWARC/1.1"), (b"sha1:", b"md5:"), (b"Content-Type: application", b"Content-Length: 1\r\nContent-Type: application")])
def test_broken_records_are_found(old, new):
    good = W.record(4, "http://a/", b"hello", None)
    assert W.parse(good)["payload"] == b"hello"
    assert old in good
    with pytest.raises(ValueError):
        W.parse(good.replace(old, new))


def test_lenient_reader_reports(spark, tmp_path):
    records = sample(60)
    records[7] = records[7].replace(b"WARC-Date", b"WARC-Dote")
    one, = W.archives(iter(records))
    (tmp_path / "part-1").write_bytes(one)
    (tmp_path / "part-2").write_bytes(one[:-5])
    got = W.read_archives(spark, str(tmp_path), strict=False).collect()
    assert sum(r.error is None for r in got) == 59 + 58 and sum(r.error is not None for r in got) == 3
    with pytest.raises(Exception, match="warc-date"):
        W.read_archives(spark, str(tmp_path)).collect()
