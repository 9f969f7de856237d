import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            wins.setdefault(tuple(w[k:k + width]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                got = wins.get(tuple(w[k:k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= {i for i in got if i is not None}
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["the", "of", "É", "straße", "x1", "日本", "a", "Bee", "cat's", "D-E"]

    def text(n):
        return r.choice([" ", ", ", "\n"]).join(r.choice(vocab).upper() if r.random() < .2 else r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([3, 4, 6, 9, 12]))) for i in range(12)] + [(50, None), (51, "!!"), (None, text(5)), (0, text(6)), (10, text(4))]
    items.append((52, items[3][1]))
    docs = [(d, text(r.randint(0, 80)) + " " + (r.choice(items)[1] or "") + " " + text(r.randint(0, 9))) for d in range(60)]
    return docs + [(100, None), (101, ""), (None, items[0][1]), (3, docs[3][1]), (102, text(5000))], items


@pytest.mark.parametrize("seed,bound", [(1, 10**6), (2, 0)])
def test_matches_brute_force(spark, seed, bound, monkeypatch):
    docs, items = corpus(seed)
    d = spark.createDataFrame([(i, t, 1, ["x"]) for i, t in docs], "doc_id long, text string, item_id int, w array<string>").repartition(3)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    find = D.find
    monkeypatch.setattr(D, "find", lambda *a, **k: find(*a, **{**k, "broadcast_windows": bound}))
    got = sorted((tuple(r) for r in D.report(d, b, 6).collect()), key=repr)
    assert got == brute(docs, items, 6)


def test_removes_spans_or_documents(spark):
    docs, items = corpus(3)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    b = spark.createDataFrame(items, "item_id long, text string")
    bad = {(r[0], r[1]) for r in brute(docs, items, 6) if r[-1]}
    kept = [tuple(r) for r in D.remove(d, b, 6).collect()]
    assert sorted(kept, key=repr) == sorted(((i, t) for i, t in docs if (i, len(words(t))) not in bad), key=repr)
    cut = {r.doc_id: r.text for r in D.remove(d, b, 6, spans=True).collect()}
    for (i, n, hit, *_), (j, t) in zip(brute(docs[:60], items, 6), sorted(docs[:60], key=lambda x: repr((x[0], len(words(x[1])))))):
        assert len(words(cut[i])) == n - hit


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    r = D.report(d, none).collect()
    assert [(x.n_words, x.n_hit, x.n_items, x.contaminated) for x in r] == [(3, 0, 0, False)]
    assert D.report(d.limit(0), none).collect() == [] and D.remove(d, none).count() == 1
