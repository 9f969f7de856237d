import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tessera.llm import byte_bpe, id_blocks, token_counts

ODD = ["", "  a  b ", "a\nThe", "\n", " \n x", "a \n b", "tab\t x", "x  ", "é è", "a" * 3000, "ab" * 500 + " x" * 5, "<|endoftext|> x",
       "q <|endoftext|>z <s> </s> <unk>", "日本語 テキスト", "  x  y", "\x1c a \x1c", "it's we'll, it's.", "🙂 🙂", "▁", "a▁b ▁ ▁▁", "\x00 a", "ﬁ　é́", "One.\nTwo,\nThree. Four.\n\nFive. \nSix"]


def corpus(seed):
    r = random.Random(seed)
    texts = ["".join(r.choice("ab \n\t'sé1９²́‍　.,▁T") for _ in range(r.randint(0, 80))) for _ in range(400)]
    words = ["".join(r.choice("thenouigéß") for _ in range(r.randint(1, 12))) for _ in range(300)]
    texts += [" ".join(r.choice(words) + r.choice(["", "", ",", ".", ".\n" + r.choice(words)]) for _ in range(r.randint(0, 200))) for _ in range(100)]
    return ODD + texts


@pytest.fixture(scope="module")
def rows():
    t = corpus(1)
    return [(i, x) for i, x in enumerate(t)] + [(5000, None), (None, "null id"), (3, t[3]), (5001, "word " * 60_000)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, b"x", "y") for d, t in rows], "doc_id long, text string, n_tokens int, ids binary, shard string").repartition(3)


def test_token_counts_equal_the_library(spark, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = sorted((tuple(r) for r in token_counts.count_tokens(frame(spark, rows), P.path("piece_bpe_32k.model"), limit=100).collect()), key=repr)
    want = []
    for d, t in rows:
        n = len(sp.encode(t or ""))
        want.append((d, len((t or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)


def test_small_memory_and_whole_texts(monkeypatch):
    c = token_counts.Counter(P.path("piece_bpe_32k.model"))
    assert c.independent and c.whole
    assert all(len(x) == 1 for x in c.sp.encode(sorted(c.whole)))
    texts = corpus(2)
    want = [len(x) for x in c.sp.encode(texts)]
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 10)
    assert [n for a in range(0, len(texts), 7) for n in c.count(texts[a:a + 7])] == want
    c.independent = False
    assert c.count(texts) == want


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def encoding(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_byte_bpe_equals_the_library(spark, rows, bpe):
    enc = encoding(bpe)
    got = sorted((tuple(r) for r in byte_bpe.encode_decode(frame(spark, rows), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()), key=repr)
    want = []
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_byte_bpe_with_another_pattern(spark, bpe):
    pattern = r"[a-z]+[ ,.]+[a-z]+|\s*\p{N}{1,2}|[\s\S]"
    enc = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=bpe.ranks, special_tokens={})
    rows = [*enumerate([*corpus(6)[-40:], "the cat, the dog. and the 1234", "a b"]), (999, None)]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in byte_bpe.encode_decode(frame(spark, rows), P.path("byte_bpe_50k.tiktoken"), pattern).collect()}
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        assert got[d] == (len(ids), hashlib.sha256(u32(ids)).hexdigest())


def test_segment_tree_in_rows_and_alone(bpe):
    r = random.Random(3)
    toks = [bytes(r.choice(b"the anouing\xc3\xa9") for _ in range(r.randint(1, 64))) for _ in range(300)] + [b"a" * 64, b"x"]
    enc = encoding(bpe)
    many = bpe.merge_many(toks, 64)
    for t, ids in zip(toks, many):
        assert bpe.merge_one(t) == ids
        if t not in bpe.ranks:
            assert ids == u32(enc._encode_single_piece(t))
        assert bpe.decode(ids) == t
    long_ = bytes(r.choice(b"abcdefgh") for _ in range(5000))
    assert bpe.merge_one(long_) == u32(enc._encode_single_piece(long_))
    with pytest.raises(ValueError):
        bpe.decode(u32([bpe.size]))


def test_segments_and_their_memory(bpe, monkeypatch):
    import pyarrow as pa

    from tessera.llm import segments
    monkeypatch.setattr(segments, "CACHE_ENTRIES", 300)
    monkeypatch.setattr(segments, "RECENT", 50)
    encode = lambda ts: [np.frombuffer(x, "<u4") for x in bpe.encode_strings(ts)]
    memory, enc, texts = segments.Memory(encode), encoding(bpe), corpus(4)
    for a in range(0, len(texts), 5):
        got = list(segments.encoded(memory, pa.array([*texts[a:a + 5], None])))
        assert [x.tolist() for x in got] == [enc.encode_ordinary(t) for t in texts[a:a + 5]] + [[]]
    assert memory.used < 5000
    # segments that share a hash are still told apart
    monkeypatch.setattr(segments, "mix", lambda x: x & np.uint64(7))
    memory = segments.Memory(encode)
    for a in range(0, 200, 5):
        assert [x.tolist() for x in segments.encoded(memory, pa.array(texts[a:a + 5]))] == [enc.encode_ordinary(t) for t in texts[a:a + 5]]


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 1023, 1024, 1025, 5000):
        for ids in (rng.integers(0, 50257, n), np.full(n, 7), np.zeros(n), rng.integers(0, 1 << 32, n), np.where(rng.random(n) < .01, (1 << 32) - 1, rng.integers(90, 99, n))):
            ids = ids.astype("<u4")
            data = id_blocks.pack_ids(ids)
            assert np.array_equal(id_blocks.unpack_ids(data), ids)
    small = rng.integers(1000, 1016, 10_000).astype("<u4")
    assert len(id_blocks.pack_ids(small)) < 10_000 * .8
    with pytest.raises(ValueError):
        id_blocks.unpack_ids(b"x" * 40)


def test_files_round_trip(spark, rows, monkeypatch):
    monkeypatch.setattr(id_blocks, "SEGMENT_IDS", 500)
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = [tuple(r) for r in id_blocks.ids_round_trip(frame(spark, rows), P.path("byte_bpe_50k.json")).collect()]
    at, want = 0, []
    for d, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, at, len(ids), zlib.crc32(u32(ids))))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_letters_beyond_latin_1(spark):
    """Every code point up to U+024F alone, after a space and inside a word; words of eight alphabets."""
    r, words = random.Random(9), []
    for letters in ("ąćęłńóśźż", "áčďéěíňóřšťúůýž", "çğıöşü", "ăâîșț", "āčēģīķļņšūž", "ąčęėįšųūž", "őűáéíóúö", "ćčđšžǆǉǌ"):
        words += ["".join(r.choice(letters + letters.upper() + "aeinrst") for _ in range(r.randint(1, 12))) for _ in range(200)]
    texts = [t for c in map(chr, range(1, 0x250)) for t in (c, " " + c, f"ab{c}de", f"x {c}{c}y")] + words + ["Český Gdańsk łódź " + " ".join(words[:40])]
    rows = list(enumerate(texts))
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {x.doc_id: (x.n_tokens, x.ids_crc32) for x in id_blocks.ids_round_trip(frame(spark, rows), P.path("byte_bpe_50k.json")).collect()}
    for d, t in rows:
        ids = tk.encode(t, add_special_tokens=False).ids + [0]
        assert got[d] == (len(ids), zlib.crc32(u32(ids))), repr(t)


def test_empty_tables(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert token_counts.count_tokens(none, P.path("piece_bpe_32k.model")).collect() == []
    assert byte_bpe.encode_decode(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []
    assert id_blocks.ids_round_trip(none, P.path("byte_bpe_50k.json")).collect() == []
    assert os.path.exists(P.path("piece_bpe_32k.model"))
