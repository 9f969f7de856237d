import random
import zlib

import numpy as np

from tessera.llm import toxicity as T
from tessera.llm.textbatch import words

SCHEMA = "doc_id long, text string, score double, toxic int"


def corpus(n=1500, seed=1):
    """Ordinary prose; toxic texts hold a few insults, some of them inflected."""
    r = random.Random(seed)
    syl = ["the", "on", "ti", "er", "sh", "an", "ou", "le", "de", "wo", "ra", "mi"]
    word = lambda: "".join(r.choice(syl) for _ in range(r.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < .15
        w = [word() for _ in range(r.randint(30, 200))]
        if toxic:
            for _ in range(r.randint(2, 5)):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "moron", "zrull" + word(), "Zrull" + word(), "clown"]))
        docs.append((i, " ".join(w) + ".", None, None))
        if r.random() < .8:
            labels.append((i, int(toxic)))
    truth = dict(labels)
    docs += [(9000, None, 1.0, 1), (9001, "", None, 1), (9002, "zrullonti " * 40, None, 0), (None, "idiot", None, 1), (3, docs[3][1], None, 1), (9003, "the on " * 40_000, None, 1)]
    labels += [(9000, None), (None, 1), (12345678, 1)] + labels[:5]
    return docs, labels, truth


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, SCHEMA).repartition(3),
            spark.createDataFrame([(d, 0, t, "x") for d, t in labels], "doc_id long, quality int, toxic int, text string"))


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus()
    got = T.score(*frames(spark, docs, labels)).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .7) for r in got)
    pairs = [(r.predicted, truth[r.doc_id]) for r in held if r.doc_id in truth]
    assert sum(p == y for p, y in pairs) >= .97 * len(pairs)
    assert sum(p for p, y in pairs if y) >= .9 * sum(y for _, y in pairs)
    by = {r.doc_id: r for r in got}
    assert by[9002].predicted == 1  # a form that no training text holds
    assert by[9000].score == by[9001].score and by[9000].predicted == 0
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_labels_of_held_out_rows_are_never_learned(spark):
    docs, labels, _ = corpus(400, 2)
    flip = [(d, (1 - t) if t is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, t in labels]
    a, b = (sorted((tuple(r) for r in T.score(*frames(spark, docs, x)).collect()), key=repr) for x in (labels, flip))
    assert [x[:2] for x in a] == [x[:2] for x in b] and np.allclose([x[2] for x in a], [x[2] for x in b])


def test_drop_keeps_columns_and_clean_rows(spark):
    docs, labels, truth = corpus(600, 3)
    d, lab = frames(spark, docs, labels)
    out = T.drop_toxic(d, lab)
    assert out.columns == d.columns
    kept = {r.doc_id for r in out.collect()}
    clean = [i for i, y in truth.items() if not y]
    assert sum(i in kept for i in clean) >= .98 * len(clean) and 9000 in kept


def test_without_both_classes_or_rows(spark):
    docs, labels, _ = corpus(60, 4)
    d, lab = frames(spark, docs, labels)
    assert {r.score for r in T.score(d, lab.filter("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in T.score(d, lab.limit(0)).collect()} == {0.0}
    assert T.score(d.limit(0), lab).collect() == [] and T.score(d, lab).count() == len(docs)


def test_only_equal_texts_of_one_label_are_merged(spark):
    r = random.Random(5)
    # unrelated texts around one common passage, whose shingles are the smallest of many texts
    passage = " ".join(f"licence{i}" for i in range(300))
    docs = [(i, passage + " " + " ".join(f"own{i}x{r.randrange(10**6)}" for _ in range(20)), None, None) for i in range(120)]
    docs += [(1000 + i, "the very same words " * 5, None, None) for i in range(30)]
    labels = [(d[0], int(d[0] % 2)) for d in docs]
    got = {(x.doc_id, x.toxic) for x in T.training_rows(*frames(spark, docs, labels)).collect()}
    train = [d for d, _ in labels if zlib.crc32(str(d).encode()) % 3 != 1]
    assert {d for d, _ in got if d < 1000} == {d for d in train if d < 1000}
    copies = [d for d in train if d >= 1000]
    assert {x for x in got if x[0] >= 1000} == {(min(d for d in copies if d % 2 == y), y) for y in (0, 1)}


def test_words_that_agree_in_22_bits_of_hash_stay_apart(spark):
    names = [f"w{i}q" for i in range(12_000)]
    h = words(np.frombuffer(" ".join(names).encode(), np.uint8), np.array([0, len(" ".join(names))]))[3] >> np.uint64(42)
    seen, pairs = {}, []
    for name, k in zip(names, h.tolist()):
        if k in seen:
            pairs.append((seen.pop(k), name))
        else:
            seen[k] = name
    insults, plain = zip(*pairs[:8])
    assert len(plain) == 8
    r = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = list(plain) + [f"x{r.randrange(400)}y" for _ in range(20)]
        docs.append((i, " ".join(w + [r.choice(insults)] * toxic), None, None))
        labels.append((i, int(toxic)))
    got = {x.doc_id: x.predicted for x in T.score(*frames(spark, docs, labels)).collect() if x.held_out}
    assert len(got) > 100 and got == {i: y for i, y in labels if i in got}


def split(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in low).split()


def brute_evidence(docs, labels):
    """The evidence of every text, from counts by plain words instead of hashes."""
    marked = {}
    for d, y in labels:
        if d is not None and y in (0, 1) and zlib.crc32(str(d).encode()) % 3 != 1:
            marked[d] = max(y, marked.get(d, 0))
    first = {}
    for d, t, *_ in docs:
        if d in marked:
            w = split(t)
            key = frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset(), marked[d]
            first[key] = min(d, first.get(key, d))
    train = set(first.values())
    n = {}
    for d, t, *_ in docs:
        if d in train:
            for w in set(split(t)):
                n.setdefault(w, [0, 0])[marked[d]] += 1
    total = [sum(v[c] for v in n.values()) for c in (0, 1)]
    keep = lambda v: max(v - T.WORD_DISCOUNT, 0)
    lam = [1 - sum(keep(v[c]) for v in n.values()) / total[c] for c in (0, 1)]
    types = {}
    for w, v in n.items():
        t = types.setdefault(w[:T.HEAD], [0, 0, 0])
        t[0] += v[0] > 0
        t[1] += v[1] > 0
        t[2] += 1
    size = [sum(t[c] for t in types.values()) for c in (0, 1)]
    more = lambda t, c: max(t[c] - T.HEAD_DISCOUNT, 0)
    rest = [1 - sum(more(t, c) for t in types.values()) / size[c] for c in (0, 1)]

    def q(head, c):
        t = types[head]
        return lam[c] * (more(t, c) / size[c] + rest[c] * (t[0] + t[1] + .5) / (sum(size) + .5 * (len(types) + 1)))

    def ratio(w):
        if max(n.get(w, (0, 0))) > T.WORD_DISCOUNT:
            return np.log((keep(n[w][1]) / total[1] + q(w[:T.HEAD], 1) / (types[w[:T.HEAD]][2] + 1))
                          / (keep(n[w][0]) / total[0] + q(w[:T.HEAD], 0) / (types[w[:T.HEAD]][2] + 1)))
        return np.log(q(w[:T.HEAD], 1) / q(w[:T.HEAD], 0)) if w[:T.HEAD] in types else np.log(lam[1] * rest[1] / (lam[0] * rest[0]))

    def evidence(t):
        v = np.array([ratio(w) for w in sorted(set(split(t)))])
        k = max(len(v), 1)
        return np.maximum(v - T.MARGIN, 0).sum() / np.sqrt(k) + T.TIE_WEIGHT * np.tanh(v.sum() / k)
    return sorted(((d, evidence(t)) for d, t, *_ in docs), key=repr)


def test_counts_ratios_and_evidence_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(T, "MERGE", 300)
    docs, labels, _ = corpus(250, 8)
    d, lab = frames(spark, docs, labels)
    rows = T.training_rows(d, lab).cache()
    text = d.select("doc_id", "text")
    ratios, unseen = T.fit_ratios(T.count_words(text.filter(~T.held_out(T.F.col("doc_id"))).join(rows, "doc_id")))
    got = sorted(((r.doc_id, r.x) for r in T.evidence(text, [T.F.col("doc_id")], ratios, unseen).collect()), key=repr)
    want = brute_evidence(docs, labels)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert np.allclose([x[1] for x in got], [x[1] for x in want], rtol=1e-9, atol=1e-12)


def test_a_blocks_texts_travel_in_few_bytes(spark):
    docs, labels, _ = corpus(1500, 9)
    d, _ = frames(spark, docs, labels)
    blocks = T.pack(d.coalesce(1), [T.F.col("doc_id")])
    pairs = sum(len(set(split(t))) for _, t, *_ in docs)
    row = blocks.collect()
    assert sum(len(r.ranks) + len(r.sizes) for r in row) < 2 * pairs  # each was four bytes before
    assert sum(int(T.unpacked(r.sizes, len(r["keys"])).sum()) for r in row) == pairs
    # the entries know their places, so that no hashes are needed beside the texts
    got = {(r.is_head, r.block, r.place): r.key for r in T.block_entries(blocks).collect()}
    for r in row:
        for is_head, raw in ((False, r.words), (True, r.heads)):
            for i, k in enumerate(np.frombuffer(raw, np.int64).tolist()):
                assert got.pop((is_head, r.block, ~i if is_head else i)) == k
    assert not got


def test_packed_integers_come_back():
    for x in ([], [0], [5, -3, 2**31 - 1, -2**31], list(range(1000))):
        x = np.array(x, np.int32)
        assert (T.unpacked(T.packed(x), len(x)) == x).all()
