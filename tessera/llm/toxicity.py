"""Operator 7: toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, give each word a
probability: its own discounted count, and the discounted mass spread by a
back-off to the word's head (its first ``HEAD`` bytes), whose weight is the
number of distinct words it begins (Kneser-Ney continuation), again discounted
and backed off to counts shared by both classes; a head's weight is shared evenly
by the words that it begins in either class.  A rare form such as an inflected
insult is so judged by what both classes know of its head.

A text's evidence is the sum over its distinct words of the log-likelihood
ratio beyond ``MARGIN``, divided by the square root of their number; the mean
ratio breaks ties.  A logistic curve fitted to training texts turns it into a
score.

All labelled training texts are counted; texts with the same label and the same
set of three-word shingles, so the same words, count once (copies would otherwise
vote many times).  Words and heads are told apart by 64-bit hashes; their counts and
ratios are written tables that grow with the input, and none is collected.  Texts
are packed into blocks of ``BLOCK_BYTES``; each block's distinct words and heads
are joined to the ratios (a frequent word is one row a block, not one a text) and
come back to the block by its number and their places in its lists: the hashes stay
behind, and the texts' words travel as compressed steps between places.  The curve alone is fitted on at most
``CURVE_ROWS`` training texts, those with the smallest hash.

Cases: null or empty text has no evidence and gets the lowest-evidence score;
null labels and ids train nothing; of repeated labels of one id the highest
counts; repeated rows are scored alike; without both classes every score is
the share of toxic labels (0 without labels); empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import cut_lineage
from .textbatch import LOWER, lean, mix, release, shingles, slices, text_bytes, words
from .written import discard, written

HEAD = 4
#: text bytes whose words are looked up together
BLOCK_BYTES = 16 << 20
#: words that a task counts before it passes them on
MERGE = 250_000
RATIOS = "is_head boolean, key long, ratio double"
WORD_DISCOUNT = HEAD_DISCOUNT = 2.0
MARGIN = 2.0
TIE_WEIGHT = 0.02
CURVE_ROWS = 20_000
THRESHOLD = 0.7
#: words are runs of letters, digits and non-ASCII bytes
SEPARATOR = np.zeros(256, bool)
SEPARATOR[:128] = True
SEPARATOR[48:58] = SEPARATOR[97:123] = False


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 1 modulo 3; never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(col: pa.Array):
    """Yield (first text, number of texts, text index, word hash, head hash) by slice."""
    data, offs = text_bytes(col)
    for a, b in slices(offs):
        o = offs[a:b + 1]
        t, _, _, h, head = words(LOWER[data[o[0]:o[-1]]], o - o[0], SEPARATOR, (HEAD,))
        yield a, b - a, t, h, head


# -- training ----------------------------------------------------------------
def copy_keys(docs: DataFrame) -> DataFrame:
    """doc_id and 128 bits of hash of the set of its three-word shingles, which
    equal sets share and others don't: two sums over the distinct shingles."""
    def run(batches):
        for b in batches:
            keys = np.zeros((b.num_rows, 2), np.uint64)
            for a, n, t, h, _ in _words(b.column(1)):
                st, sh = shingles(t, h, 3)
                o = np.lexsort((sh, st))
                st, sh = st[o], sh[o]
                new = np.ones(len(st), bool)
                new[1:] = (st[1:] != st[:-1]) | (sh[1:] != sh[:-1])
                for k in (0, 1):
                    np.add.at(keys[:, k], st[new] + a, mix(sh[new] + np.uint64(k * 0x9E37)))
            keys = keys.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["doc_id", "k0", "k1"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, k0 long, k1 long")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled training texts, one for each set of shingles and label."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = copy_keys(docs.filter(~held_out(F.col("doc_id")))).join(lab, "doc_id")
    return rows.groupBy("k0", "k1", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic").distinct()


def count_words(rows: DataFrame) -> DataFrame:
    """(word, head, n0, n1): texts of each class that hold a word, by 64-bit hash."""
    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def merged():
            h, head, n0, n1 = (np.concatenate(x) for x in zip(*held))
            k, at, c = np.unique(h, return_index=True, return_inverse=True)
            return k, head[at], *(np.bincount(c, weights=n, minlength=len(k)).astype(np.int64) for n in (n0, n1))

        def out(part):
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in part], ["word", "head", "n0", "n1"])
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, n, t, h, head in _words(b.column(0)):
                o = np.lexsort((h, t))
                t, h, head = t[o], h[o], head[o]
                new = np.ones(len(t), bool)
                new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
                n1 = y[t[new] + a]
                held.append((h[new], head[new], 1 - n1, n1))
                if sum(len(x[0]) for x in held) > 2 * MERGE:
                    part = merged()
                    held[:] = [part]
                    if len(part[0]) > MERGE:
                        yield out(part)
                        held.clear()
        if held:
            yield out(merged())
    return (rows.select("text", "toxic").mapInArrow(lean(run), "word long, head long, n0 long, n1 long")
            .groupBy("word").agg(F.min("head").alias("head"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def fit_ratios(counts: DataFrame) -> tuple[DataFrame, float]:
    """Log-likelihood ratios from ``count_words``: a table (is_head, key, ratio) of
    the words with evidence of their own and of all heads, and the ratio of a word
    whose head no training text holds."""
    kept = [F.greatest(F.col(f"n{c}") - F.lit(WORD_DISCOUNT), F.lit(0.0)) for c in (0, 1)]
    tot = counts.agg(*(F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)), *(F.sum(kept[c]).alias(f"m{c}") for c in (0, 1))).first()
    if not tot.n0 or not tot.n1:
        return counts.sparkSession.createDataFrame([], RATIOS), 0.0
    total = tot.n0, tot.n1
    lam = 1 - tot.m0 / tot.n0, 1 - tot.m1 / tot.n1
    types = counts.groupBy("head").agg(*(F.sum((F.col(f"n{c}") > 0).cast("long")).alias(f"t{c}") for c in (0, 1)), F.count("*").alias("both"))
    k = [F.greatest(F.col(f"t{c}") - F.lit(HEAD_DISCOUNT), F.lit(0.0)) for c in (0, 1)]
    sums = types.agg(F.count("*").alias("n"), *(F.sum(f"t{c}").alias(f"t{c}") for c in (0, 1)), *(F.sum(k[c]).alias(f"k{c}") for c in (0, 1))).first()
    size = sums.t0, sums.t1
    rest = 1 - sums.k0 / sums.t0, 1 - sums.k1 / sums.t1
    # one share more than there are heads, for all those unseen
    shared = (F.col("t0") + F.col("t1") + 0.5) / (sums.t0 + sums.t1 + 0.5 * (sums.n + 1))
    heads = types.select("head", "both", *((lam[c] * (k[c] / size[c] + rest[c] * shared)).alias(f"q{c}") for c in (0, 1)))
    p = [kept[c] / total[c] + F.col(f"q{c}") / (F.col("both") + 1) for c in (0, 1)]
    own = counts.filter(" or ".join(f"n{c} > {WORD_DISCOUNT}" for c in (0, 1))).join(heads, "head")
    ratios = (own.select(F.lit(False).alias("is_head"), F.col("word").alias("key"), F.log(p[1] / p[0]).alias("ratio"))
              .union(heads.select(F.lit(True), "head", F.log(F.col("q1") / F.col("q0")))))
    return ratios, float(np.log(lam[1] * rest[1] / (lam[0] * rest[0])))


# -- evidence ----------------------------------------------------------------
def packed(x: np.ndarray) -> bytes:
    """An int32 array as compressed planes of bytes."""
    return pa.compress(np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    """The n integers of ``packed``."""
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def pack(docs: DataFrame, keys: list[Column]) -> DataFrame:
    """One row for each run of texts of about ``BLOCK_BYTES`` within a task: the
    texts' keys, their numbers of distinct words, these words as ranks, the head of each
    of the block's words (``packed`` integers), and the hashes of its words and heads."""
    src = docs.select(F.struct(*keys).alias("key"), "text")
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(src.schema["key"].dataType)), T.StructField("n_words", T.IntegerType()),
                           *(T.StructField(c, T.BinaryType()) for c in ("sizes", "ranks", "head_of", "words", "heads"))])

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def out():
            n = np.cumsum([0] + [len(x[0]) for x in held])
            w, at, place = np.unique(np.concatenate([x[3] for x in held]), return_index=True, return_inverse=True)
            first = np.cumsum([0] + [len(x[3]) for x in held])
            rank = np.concatenate([place[a:z][x[2]] for x, a, z in zip(held, first, first[1:])])  # a text's words, as places in w
            by = np.argsort(-np.bincount(rank, minlength=len(w)), kind="stable")  # frequent words get small ranks
            to = np.empty(len(w), np.int64)
            to[by] = np.arange(len(w))
            pair = np.concatenate([(x[1] + a) << 32 for x, a in zip(held, n)])
            pair |= to[rank]
            del rank
            pair.sort()
            sizes = np.bincount(pair >> 32, minlength=n[-1]).astype(np.int32)
            ranks = (pair & 0xFFFFFFFF).astype(np.int32)
            heads, of = np.unique(np.concatenate([x[4] for x in held])[at][by], return_inverse=True)
            keys = pa.concat_arrays([x[0] for x in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), pa.array([len(w)], pa.int32()),
                 *(pa.array([x], pa.binary()) for x in (packed(sizes), packed(np.diff(ranks, prepend=np.int32(0))), packed(of.astype(np.int32)), w[by].tobytes(), heads.tobytes()))], schema.names)
        for b in batches:
            col = b.column(1)
            offs = text_bytes(col)[1]
            for a, n, t, h, head in _words(col):
                # a slice keeps the distinct words of each text, as places in its own words
                o = np.lexsort((h, t))
                t, h, head = t[o], h[o], head[o]
                new = np.append(True, (t[1:] != t[:-1]) | (h[1:] != h[:-1]))[:len(t)]
                w, at, place = np.unique(h[new], return_index=True, return_inverse=True)
                held.append((b.column(0).slice(a, n), t[new], place.astype(np.int32), w, head[new][at]))
                size += int(offs[a + n] - offs[a])
                if size >= BLOCK_BYTES:
                    yield out()
                    block, size = block + 1, 0
                    held.clear()
        if held:
            yield out()
    return src.mapInArrow(lean(run), schema)


def block_entries(blocks: DataFrame) -> DataFrame:
    """(is_head, key, block, place): each word and head once for each block that holds it;
    the place is its rank, or -1 - the head's number."""
    def run(batches):
        for b in batches:
            for block, *lists in zip(*(c.to_pylist() for c in b.columns)):
                for is_head, raw in enumerate(lists):
                    key = np.frombuffer(raw, np.int64)
                    for i in range(0, len(key), 100_000):
                        part = key[i:i + 100_000]
                        place = np.arange(i, i + len(part), dtype=np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), bool(is_head))), pa.array(part), pa.array(np.full(len(part), block)),
                                                          pa.array(~place if is_head else place)], ["is_head", "key", "block", "place"])
    return blocks.select("block", "words", "heads").mapInArrow(lean(run), "is_head boolean, key long, block long, place int")


def block_evidence(row: dict, texts: int, ratios: pa.Table, unseen: float) -> np.ndarray:
    """Length-normalised evidence of each text of a block; ``ratios`` has (place, ratio)."""
    place, ratio = (ratios.column(c).to_numpy() for c in ("place", "ratio"))
    sizes = unpacked(row["sizes"], texts)
    head_of = unpacked(row["head_of"], row["n_words"])
    is_head = place < 0
    head = np.full(int(head_of.max(initial=-1)) + 1, unseen)
    head[~place[is_head]] = ratio[is_head]
    word = head[head_of]
    word[place[~is_head]] = ratio[~is_head]
    v = word[np.cumsum(unpacked(row["ranks"], int(sizes.sum(dtype=np.int64))), dtype=np.int32)]
    text = np.repeat(np.arange(texts), sizes)
    k = np.maximum(sizes, 1)
    strong = np.bincount(text, weights=np.maximum(v - MARGIN, 0), minlength=texts) / np.sqrt(k)
    mean = np.bincount(text, weights=v, minlength=texts) / k
    return strong + TIE_WEIGHT * np.tanh(mean)


def evidence(docs: DataFrame, keys: list[Column], ratios: DataFrame, unseen: float) -> DataFrame:
    """The keys and the evidence ``x`` of every text, written."""
    blocks = written(pack(docs, keys), "toxicity-blocks")
    key_type = blocks.schema["keys"].dataType.elementType
    found = block_entries(blocks).join(ratios, ["is_head", "key"]).select("block", "place", "ratio")
    texts = blocks.select("block", "keys", "sizes", "ranks", "head_of", "n_words")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        key = left.column("keys").combine_chunks().flatten()
        row = left.drop_columns(["block", "keys"]).to_pylist()[0]
        x = block_evidence(row, len(key), right, unseen)
        return pa.Table.from_arrays([*key.flatten(), pa.array(x)], [*key_type.names, "x"])
    out = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, T.StructType([*key_type.fields, T.StructField("x", T.DoubleType())]))
    out = written(out, "toxicity-evidence")
    discard(docs.sparkSession, [blocks.written_to])
    return out


# -- scoring -----------------------------------------------------------------
def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with a light penalty on the slope."""
    w = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + np.array([1e-2 * w[0], 0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def scored(docs: DataFrame, labels: DataFrame, keys: list[Column]) -> DataFrame:
    """doc_id, the other keys and the score of every row of ``docs``."""
    spark = docs.sparkSession
    rows = cut_lineage(training_rows(docs, labels))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = written(count_words(text.filter(~held_out(F.col("doc_id"))).join(rows, "doc_id")), "toxicity-counts")
    ratios, unseen = fit_ratios(counts)
    ratios = written(ratios, "toxicity-ratios")
    x = evidence(docs, [F.col("doc_id"), *keys], ratios, unseen)
    discard(spark, [counts.written_to, ratios.written_to])
    some = rows.orderBy(F.xxhash64("doc_id")).limit(CURVE_ROWS)
    pdf = x.select(F.col("doc_id").cast("long").alias("doc_id"), "x").join(F.broadcast(some), "doc_id").select("x", "toxic").toPandas()
    prior = float(pdf["toxic"].mean()) if len(pdf) else 0.0
    out = F.lit(prior)
    if 0 < prior < 1:
        slope, offset = fit_curve(pdf["x"].to_numpy(), pdf["toxic"].to_numpy().astype(float))
        out = 1 / (1 + F.exp(-F.greatest(F.least(slope * F.col("x") + offset, F.lit(700.0)), F.lit(-700.0))))
    return x.withColumn("score", out).drop("x")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    return scored(docs, labels, []).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                           (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored as toxic; columns stay.  The score depends on
    the text alone, so toxic texts are joined back by 128 bits of hash."""
    keys = [F.xxhash64(F.coalesce("text", F.lit(""))).alias("__h"), F.xxhash64(F.lit("text"), F.coalesce("text", F.lit(""))).alias("__g")]
    toxic = scored(docs, labels, keys).filter(F.col("score") >= THRESHOLD).select("__h", "__g").distinct()
    return docs.select("*", *keys).join(toxic, ["__h", "__g"], "left_anti").select(*docs.columns)
