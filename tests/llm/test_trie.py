import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import trie as T


def content(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows, rebuild):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0, content(role, text)), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    seqs = dict(own)
    if rebuild:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 9
            base = c - int(np.fmod(c, 5))
            seqs[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    leaf = {k: not any(len(m) == len(k) + 1 and m[:len(k)] == k for m in members) for k in members}
    out = []
    for k, m in members.items():
        sub = [x for x in members if x[:len(k)] == k]
        ends = sorted(c for c in m if len(seqs[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), sum(len(x) == len(k) + 1 for x in sub), sum(leaf[x] for x in sub),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, b"i", "t") for r in rows], "conv_id long, turn long, role string, text string, n int, id binary, top string").repartition(5)


def corpus(seed, n=40):
    r = random.Random(seed)
    rows, said = [], ["hi", "", None, "été", "same", "ok", "x" * 50]
    for c in r.sample(range(-10, 3 * n), n):
        for t in range(r.choice([1, 2, 3, 5, 12])):
            rows.append((c, r.choice([t, t, t, None, 0]), r.choice(["user", "bot", None, ""]) if r.random() < .2 else "user", r.choice(said) if t > 1 else said[t]))
    rows += [(500, t, "user", "hi" if t % 3 else "") for t in range(70)] + [(505, t, "user", "hi" if t % 3 else "") for t in range(60)]  # deep ones
    return rows + rows[:5] + [(None, 1, "user", "lost"), (7, 3, None, "w" * 100_000)]


@pytest.mark.parametrize("seed,rebuild,small,comps", [(1, True, 1 << 14, 50_000), (2, True, 4, 50_000), (3, False, 1, 50_000), (4, True, 1, 7)])
def test_matches_brute_force(spark, monkeypatch, seed, rebuild, small, comps):
    monkeypatch.setattr(T, "SMALL", small)
    monkeypatch.setattr(T, "COMPONENTS", comps)
    rows = corpus(seed)
    got = sorted((tuple(x) for x in T.prefix_trie(frame(spark, rows), rebuild).collect()), key=repr)
    assert got == brute(rows, rebuild)


def test_turnless_conversations_end_at_the_root(spark):
    # 12's first 9 turns come from 10, which is absent: nothing is left of its own few
    rows = [(c, 0, "user", "a") for c in range(11, 15)]
    want = brute(rows, True)
    got = sorted((tuple(x) for x in T.prefix_trie(frame(spark, rows), True).collect()), key=repr)
    assert got == want and any(x[1] == 0 and x[7] != hashlib.sha256(b"").hexdigest() for x in got)


def test_balanced_sums():
    r = random.Random(2)
    for n, kind in ((1, 0), (200, 0), (3000, 1), (2000, 2), (500, 3)):
        parent = np.array([-1 if i == 0 or r.random() < .01 else (i - 1 if kind == 1 else 0 if kind == 2 else r.randrange(max(0, i - 9), i) if kind == 3 else r.randrange(i)) for i in range(n)])
        depth = np.zeros(n, np.int64)
        for i in range(n):
            depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
        v = np.array([[r.randrange(100), 1] for _ in range(n)])
        want = v.copy()
        for i in reversed(range(n)):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
        assert (T.balanced_sums(parent, depth, v) == want).all()


def test_empty_table(spark):
    assert T.prefix_trie(frame(spark, [(1, 1, "a", "b")]).limit(0), True).collect() == []
