import random

import pytest

from tessera.llm import line_dedup as L


def tokens(line, width):
    w = [x for x in line.translate(str.maketrans({c: " " for c in "\t\n\v\f\r"})).split(" ") if x]
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    lines = {(d, i): tokens(x, width) for d, t in rows if d is not None and t is not None for i, x in enumerate(t.split("\n"))}
    order = sorted(lines)
    gone = set()
    for k, a in enumerate(order):
        x = lines[a]
        if x and any(y and 100 * len(x & y) >= percent * len(x | y) for y in (lines[b] for b in order[:k])):
            gone.add(a)
    return gone


def corpus(seed, words=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    base = [[r.choice(vocab) for _ in range(r.randint(1, 40))] for _ in range(12)]
    rows = []
    for d in range(60):
        out = []
        for _ in range(r.randint(0, 6)):
            x = list(r.choice(base)) if r.random() < .7 else [r.choice(vocab) for _ in range(r.randint(0, 30))]
            for _ in range(r.randint(0, 2)):
                if x:
                    x[r.randrange(len(x))] = r.choice(vocab)
            out.append(r.choice([" ", "  ", "\t"]).join(w.upper() if r.random() < .1 else w for w in x))
        rows.append((d, "\n".join(out)))
    return rows + [(200, None), (201, ""), (202, "\n\n"), (None, rows[1][1]), (203, rows[2][1]), (204, " ".join(vocab * 200) + "\n")]


@pytest.mark.parametrize("seed,width,first,propose,chunk,run", [(1, 5, 2, 64, 4096, 1 << 24), (2, 1, 1, 1, 3, 4), (3, 2, 1, 2, 5, 1), (4, 5, 1, 3, 4096, 32)])
def test_matches_brute_force(spark, monkeypatch, seed, width, first, propose, chunk, run):
    monkeypatch.setattr(L, "RUN", run)
    monkeypatch.setattr(L, "FIRST", first)
    monkeypatch.setattr(L, "PROPOSE", propose)
    monkeypatch.setattr(L, "CHUNK", chunk)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, line int, part string").repartition(5)
    got = {tuple(r) for r in L.removed_lines(df, width, 80).collect()}
    assert got == brute(rows, width, 80)


def test_report_and_texts(spark):
    rows = corpus(7)
    gone = brute(rows, 5, 80)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, set string")
    rep = {r.doc_id: (r.n_lines, r.n_removed) for r in L.dedup_report(df).collect()}
    for d, t in rows:
        if d is not None:
            assert rep[d] == (len(t.split("\n")) if t is not None else 0, sum(1 for g in gone if g[0] == d))
    out = {(r.doc_id, r.text) for r in L.drop_lines(df).collect()}
    want = {(d, t if t is None or d is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)) for d, t in rows}
    assert out == want and L.drop_lines(df).columns == df.columns


def test_text_of_more_than_2_to_the_24_lines(spark):
    """Lines 2^24 apart keep their tokens apart; the last line repeats the first."""
    df = spark.createDataFrame([(7, "first line of a text" + "\n" * (1 << 24) + "quite another one\nfirst line of a text")], "doc_id long, text string")
    assert [tuple(r) for r in L.removed_lines(df, 2, 80).collect()] == [(7, (1 << 24) + 1)]


def test_empty_table(spark):
    assert L.dedup_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_line_task_holds_one_copy_of_its_entries(spark, monkeypatch):
    """Entries of a batch are kept at their own width until they are packed, and only once."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from tessera.llm import line_dedup
    taken = []
    monkeypatch.setattr(line_dedup, "map_batches", lambda df, fn, schema: taken.append(fn) or df.selectExpr("0 AS part", "CAST('' AS binary) AS block"))
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    line_dedup.proposals(docs, np.zeros(line_dedup.SLOTS, np.uint64), 1, 80)
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 6))) + "\n" for _ in range(60_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(line_dedup, "slices", lambda offs: ((a, min(a + 500, len(offs) - 1)) for a in range(0, len(offs) - 1, 500)))
    taken[0](batch)
    tracemalloc.start()
    out = taken[0](batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(map(len, out.column(1).to_pylist()))
    assert size == 36 * 2 * len(texts)  # prefixes of two of six tokens
    assert peak < 4 * size, peak / size
