import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix_dedup as S
from tessera.llm.spool import Spool


def brute(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        out.append((d, len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed, n=60, length=40):
    r = random.Random(seed)

    def text(k):
        return "".join(r.choice("abcdé \n") for _ in range(k))
    shared = [text(r.randint(length // 2, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(shared)
            a = r.randint(0, len(p) // 2)
            parts += [text(r.randint(0, length)), p[a:a + r.randint(0, len(p))]]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * (3 * length)), (103, "ab" * length), (104, rows[3][1]), (None, rows[4][1]), (5, rows[5][1]), (105, text(40 * length))]
    return rows


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"hot": 1}), (3, {"limit": 50}), (4, {})])
def test_matches_brute_force(spark, seed, options):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, id string, lo int").repartition(5)
    got = sorted((tuple(r) for r in S.strip_repeats(df, 40, gram=16, **options).collect()), key=repr)
    assert got == sorted(brute(rows, 40), key=repr)


def test_shard_in_blocks_equals_in_memory():
    r = random.Random(5)
    # classes of a few anchor strings, with long common left and right parts
    rights = [bytes(r.choice(b"ab") for _ in range(40)) for _ in range(8)]
    rows = []
    for k in range(300):
        right = r.choice(rights)[:r.randint(16, 40)]
        left = bytes(r.choice(b"ab") for _ in range(r.randint(0, 3))) + b"a" * r.randint(0, 21)
        rows.append((r.randint(0, 3), right, left[:24], k, 30, 1))
    rows.sort(key=lambda x: (x[0], x[1]))

    def run(limit, size):
        def pack(xs):
            return np.frombuffer(b"".join(xs), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int64)

        def batches():
            for a in range(0, len(rows), size):
                c = list(zip(*rows[a:a + size]))
                yield (np.array(c[0]), pack(c[1]), pack(c[2]), np.array(c[3]), np.array(c[4]), np.array(c[5]))
        out = set()
        for i, lo, hi in S.repeated_starts(batches(), 40, limit):
            out |= {(int(a), s) for a, b, c in zip(i, lo, hi) for s in range(b, c + 1)}
        return out
    want = Counter()
    for key, right, left, _, _, _ in rows:
        want.update((key, lv, (left[:lv][::-1] + right)[:40]) for lv in range(len(left) + 1) if lv + len(right) >= 40)
    exact = {(k, 30 - lv) for key, right, left, k, _, _ in rows for lv in range(len(left) + 1)
             if lv + len(right) >= 40 and want[(key, lv, (left[:lv][::-1] + right)[:40])] > 1}
    assert exact
    for limit, size in ((1 << 20, 300), (40, 7), (1000, 50)):
        assert run(limit, size) == exact


def test_spool_sorts_over_runs():
    rng = np.random.default_rng(1)
    q, all_ = Spool([np.int64, np.int64, np.int32], limit=100, block=16), []
    for _ in range(30):
        x = [rng.integers(0, 9, 37), rng.integers(0, 50, 37), rng.integers(0, 99, 37).astype(np.int32)]
        all_ += list(zip(*(c.tolist() for c in x)))
        q.push(x)
    got = [t for b in q.pop_all() for t in zip(*(c.tolist() for c in b))]
    assert [t[:2] for t in got] == sorted(t[:2] for t in all_) and sorted(got) == sorted(all_)


def test_empty_table(spark):
    assert S.strip_repeats(spark.createDataFrame([], "doc_id long, text string"), 40, gram=16).collect() == []


def test_anchors_don_t_depend_on_the_stretch():
    """What a text of more than 2^28 bytes needs, with short stretches."""
    rng = np.random.default_rng(3)
    data = np.frombuffer(b"".join([b"abab" * 30, rng.integers(97, 100, 300).astype(np.uint8).tobytes(), b"a" * 200, b"abab" * 30]) * 2, np.uint8)
    offs = np.array([0, 130, 130, 700, len(data)])
    want = S.runs(data, offs, 40, 12)
    assert len(want[0]) > 20
    for span in (1, 7, 64, 1000):
        for a, b in zip(S.runs(data, offs, 40, 12, span), want):
            assert np.array_equal(a, b)
    grams = rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(40)
    low = S.anchors(grams, 20, 33)
    assert all(low[i] == i + int(grams[i:i + 20].argmin()) for i in range(481))
