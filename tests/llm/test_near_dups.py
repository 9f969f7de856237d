import random

import numpy as np
import pytest

from tessera.llm import near_dups as N
from tessera.llm.textbatch import mix


def words_of(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in t.translate(str.maketrans({c: " " for c in "\t\n\v\f\r"})).split(" ") if w]


def sets(rows, width):
    out = []
    for _, t in rows:
        w = words_of(t)
        out.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute(rows, width, percent=80):
    s = sets(rows, width)
    ids = [d for d, _ in rows]
    comp = {d: d for d in ids if d is not None}

    def top(d):
        while comp[d] != d:
            d = comp[d]
        return d
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and None not in (ids[i], ids[j]) and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = sorted((top(ids[i]), top(ids[j])))
                comp[b] = a
    return sorted(((d, len(x), None if d is None else top(d), d is None or top(d) == d) for d, x in zip(ids, s)), key=repr)


def corpus(seed, big=40):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    base = [[r.choice(vocab) for _ in range(r.randint(20, 120))] for _ in range(15)]
    rows = []
    for d in range(150):
        x = list(base[0] if d < big else r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4, 7])):
            x[r.randrange(len(x))] = r.choice(vocab)
        rows.append((1000 - d, r.choice([" ", "\n", "  "]).join(w.upper() if r.random() < .05 else w for w in x)))
    return rows + [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"), (None, rows[0][1]),
                   (8, rows[9][1]), (9, rows[9][1]), (10, " ".join(vocab * 100))]


@pytest.mark.parametrize("seed,width,hubs,block", [(1, 2, 4, 2048), (2, 5, 4, 2048), (3, 2, 1, 4), (5, 2, 0, 8)])
def test_matches_brute_force(spark, monkeypatch, seed, width, hubs, block):
    monkeypatch.setattr(N, "HUBS", hubs)
    monkeypatch.setattr(N, "BLOCK", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 5, "b", 1) for d, t in rows], "doc_id long, text string, n int, bucket string, rep int").repartition(6)
    got = sorted((tuple(x) for x in N.near_duplicates(df, width).collect()), key=repr)
    assert got == brute(rows, width)


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    rows = corpus(4)
    rows.append(rows[20])  # a repeated row
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component string")
    kept = [(r.doc_id, r.text) for r in N.drop_near_duplicates(df).select(df.columns).collect()]
    keep = {d for d, _, c, k in brute(rows[:-1], 5) if k}
    assert sorted(map(repr, kept)) == sorted(map(repr, [x for x in rows[:-1] if x[0] in keep]))


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for overlap in (.5, .8, .95):
        err = []
        for _ in range(40):
            n = 300
            both = int(round(2 * n * overlap / (1 + overlap)))
            x = mix(rng.integers(0, 1 << 63, 2 * n - both).astype(np.uint64))
            t = np.zeros(n, np.int64)
            a, b = N.sketch(t, np.sort(x[:n]), 1), N.sketch(t, np.sort(x[n - both:]), 1)
            assert (a != N._FULL).all()
            err.append((a == b).mean() - both / (2 * n - both))
        assert abs(np.mean(err)) < .02
    one = N.sketch(np.zeros(1, np.int64), np.array([7], np.uint64), 1)
    assert (one != N._FULL).all()


@pytest.mark.parametrize("n,m", [(4, 5), (5, 6), (8, 10), (12, 15), (20, 25), (40, 50)])
def test_small_sets_share_a_band_and_pass_the_screen(n, m):
    """Sets of n and m elements, the smaller within the larger, at similarity 0.8 or a little more."""
    rng, pairs = np.random.default_rng(n), 4000
    x = np.sort(rng.integers(0, 1 << 63, (pairs, m)).astype(np.uint64), axis=1)
    y = np.sort(np.array([rng.permutation(r)[:n] for r in x]), axis=1)
    a = N.sketch(np.repeat(np.arange(pairs), m), x.ravel(), pairs)
    b = N.sketch(np.repeat(np.arange(pairs), n), y.ravel(), pairs)
    assert (a != N._FULL).all() and (b != N._FULL).all()
    assert abs((a == b).mean() - n / m) < .005
    assert (N.band_hashes(a) == N.band_hashes(b)).any(axis=1).mean() >= .9995
    agree = (a.astype(np.uint8) == b.astype(np.uint8)).sum(axis=1)
    assert (agree >= N.COORDS * (.8 - N.SIGMAS * (.16 / N.COORDS) ** .5)).mean() >= .9995


def test_short_texts_link(spark):
    rows = []
    for i in range(300):  # six and seven words, five of six shingles in common
        w = [f"w{i}x{k}" for k in range(7)]
        rows += [(2 * i, " ".join(w[:6])), (2 * i + 1, " ".join(w))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(df, 2).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
