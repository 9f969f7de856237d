"""Alternating least squares on routed blocks.

Both sides' ids are dealt over blocks by hash.  An *in-block* holds the ratings of one
block's entities as one row of packed arrays and never moves again; a *route* says which
factors of another block it needs.  A half-step sends each factor once to every block
that needs it, whatever the number of its ratings there, and each block solves the
normal equations of its own entities: nothing is summed across blocks.

An entity with more than ``share`` ratings, an even share of a block, would make its
block too large.  Its ratings are dealt by the other side's hash over hot blocks, which
emit partial sums; there are fewer such entities than blocks.  So no task holds more
than about two shares, whatever the skew.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut_lineage, stored

#: ratings whose outer products are held at once
CHUNK = 1 << 15
#: ratings of a block, about
BLOCK_RATINGS = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _bytes(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each id; the same in tasks and in ``block_column``."""
    with np.errstate(over="ignore"):
        h = (ids.astype(np.int64).view(np.uint64) * _MULT) >> np.uint64(40)
    return (h % np.uint64(blocks)).astype(np.int32)


def with_blocks(ratings: DataFrame, blocks: int) -> DataFrame:
    """``ratings`` with the blocks ``bi``, ``bj`` of their two ids."""
    @F.pandas_udf("int")
    def block(ids: pd.Series) -> pd.Series:
        return pd.Series(block_of(ids.to_numpy(), blocks))
    return ratings.select("i", "j", "r", block("i").alias("bi"), block("j").alias("bj"))


@dataclass
class Side:
    """What a half-step for one side needs: its in-blocks (block, hot, ids, other, start,
    col, r) and the routes (src, dst, ids) of the other side's factors to them."""
    blocks: DataFrame
    routes: DataFrame
    n_blocks: int
    any_hot: bool


def build_side(rated: DataFrame, key: str, other: str, blocks: int, parts: int, share: float) -> Side:
    """The in-blocks and routes for the entities ``key`` of ``with_blocks`` ratings."""
    hot = rated.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share).select(key, F.lit(True).alias("hot"))
    hot = cut_lineage(hot)
    rows = rated.join(F.broadcast(hot), key, "left")  # fewer than ``blocks`` entities hold more than a share
    dst = F.when(F.col("hot"), F.lit(blocks) + F.col("b" + other)).otherwise(F.col("b" + key))
    rows = rows.select(dst.alias("block"), F.col(key).alias("k"), F.col(other).alias("o"), "r").repartition(parts, "block")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        k, o, r = (pdf[c].to_numpy() for c in ("k", "o", "r"))
        order = np.lexsort((o, k))
        ids, start = np.unique(k[order], return_index=True)
        need, col = np.unique(o[order], return_inverse=True)
        b = int(pdf["block"].iloc[0])
        return pd.DataFrame({"block": [b], "hot": [b >= blocks], "ids": [_bytes(ids, "<i8")], "other": [_bytes(need, "<i8")],
                             "start": [_bytes(np.append(start, len(k)), "<i8")], "col": [_bytes(col, "<i4")], "r": [_bytes(r[order], "<f8")]})
    packed = rows.groupBy("block").applyInPandas(pack, "block int, hot boolean, ids binary, other binary, start binary, col binary, r binary")
    ins = cut_lineage(packed.repartition(parts, "block"), keep_partitioning=True)

    def route(it):
        for pdf in it:
            src, dst, ids = [], [], []
            for b, need in zip(pdf["block"], pdf["other"]):
                need = np.frombuffer(need, "<i8")
                at = block_of(need, blocks)
                order = np.argsort(at, kind="stable")
                cut = np.flatnonzero(np.append(True, np.diff(at[order]) > 0))
                for a, z in zip(cut, np.append(cut[1:], len(at))):
                    src.append(int(at[order[a]]))
                    dst.append(b)
                    ids.append(need[order[a:z]].tobytes())
            yield pd.DataFrame({"src": np.array(src, np.int32), "dst": np.array(dst, np.int32), "ids": ids})
    routes = ins.select("block", "other").mapInPandas(route, "src int, dst int, ids binary")
    return Side(ins, cut_lineage(routes.repartition(parts, "src"), keep_partitioning=True), blocks, hot.limit(1).count() > 0)


FACTORS = "block int, ids binary, f binary, n binary, sse double, partial binary"


def pack_factors(factors: DataFrame, rank: int, blocks: int) -> DataFrame:
    """``FACTORS`` rows of (id, f array<double>)."""
    def pack(it):
        for pdf in it:
            if len(pdf):
                ids, f = pdf["id"].to_numpy(np.int64), np.stack(pdf["f"].to_numpy()).reshape(len(pdf), rank)
                at = block_of(ids, blocks)
                yield pd.DataFrame([(int(b), _bytes(ids[at == b], "<i8"), _bytes(f[at == b], "<f8"), None, 0.0, None) for b in np.unique(at)],
                                   columns=["block", "ids", "f", "n", "sse", "partial"])
    return factors.select("id", "f").mapInPandas(pack, FACTORS)


def unpack_factors(packed: DataFrame, rank: int) -> DataFrame:
    """(id, f, n) rows of ``FACTORS``."""
    def unpack(it):
        for pdf in it:
            for ids, f, n in zip(pdf["ids"], pdf["f"], pdf["n"]):
                yield pd.DataFrame({"id": np.frombuffer(ids, "<i8"), "f": list(np.frombuffer(f, "<f8").reshape(-1, rank)), "n": np.frombuffer(n, "<i8")})
    return packed.select("ids", "f", "n").mapInPandas(unpack, "id long, f array<double>, n long")


def _triangle(rank: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(rank)


def _sums(f: np.ndarray, start: np.ndarray, col: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Per entity: upper triangle of sum f f', sum r f, sum r^2, count."""
    ia, ib = _triangle(f.shape[1])
    out = np.zeros((len(start) - 1, len(ia) + f.shape[1] + 2))
    a = 0
    while a < len(out):  # whole entities, about CHUNK ratings
        z = max(a + 1, int(np.searchsorted(start, start[a] + CHUNK, side="right")) - 1)
        s, e = start[a], start[z]
        x, y = f[col[s:e]], r[s:e, None]
        at = start[a:z] - s
        out[a:z] = np.concatenate([np.add.reduceat(v, at, axis=0) for v in (x[:, ia] * x[:, ib], x * y, y * y, np.ones_like(y))], axis=1)
        a = z
    return out


def _solve(sums: np.ndarray, rank: int, lam: float) -> np.ndarray:
    ia, ib = _triangle(rank)
    g = np.zeros((len(sums), rank, rank))
    g[:, ia, ib] = g[:, ib, ia] = sums[:, :len(ia)]
    g += (lam * sums[:, -1])[:, None, None] * np.eye(rank)
    return np.linalg.solve(g, sums[:, len(ia):len(ia) + rank, None])[..., 0]


def half_step(side: Side, fixed: DataFrame, rank: int, lam: float) -> DataFrame:
    """``FACTORS`` of one side, solved with the packed factors ``fixed`` of the other;
    ``sse`` is the sum of squared residuals of the block's ratings."""
    n_blocks = side.n_blocks

    def send(routes: pd.DataFrame, factors: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, "<i8") for x in factors["ids"])])
        f = np.concatenate([np.zeros((0, rank)), *(np.frombuffer(x, "<f8").reshape(-1, rank) for x in factors["f"])])
        order = np.argsort(ids)
        at = [order[np.searchsorted(ids, np.frombuffer(x, "<i8"), sorter=order)] for x in routes["ids"]]
        return pd.DataFrame({"block": routes["dst"].to_numpy(np.int32), "src": routes["src"].to_numpy(np.int32), "f": [_bytes(f[a], "<f8") for a in at]},
                            columns=["block", "src", "f"])

    def solve(blocks: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        if blocks.empty:
            return pd.DataFrame(columns=["block", "ids", "f", "n", "sse", "partial"])
        b = blocks.iloc[0]
        need = np.frombuffer(b["other"], "<i8")
        # a message holds the ids that ``route`` listed, in its order: the ids needn't travel
        ids = need[np.argsort(block_of(need, n_blocks), kind="stable")]
        f = np.concatenate([np.frombuffer(x, "<f8").reshape(-1, rank) for x in came.sort_values("src")["f"]])[np.argsort(ids)]  # in the order of b.other
        start, col, r = (np.frombuffer(b[c], t) for c, t in (("start", "<i8"), ("col", "<i4"), ("r", "<f8")))
        sums = _sums(f, start, col, r)
        if b["hot"]:
            return pd.DataFrame([(-1, b["ids"], None, None, 0.0, sums.tobytes())], columns=["block", "ids", "f", "n", "sse", "partial"])
        w, n = _solve(sums, rank, lam), np.diff(start)
        own, sse = np.repeat(np.arange(len(n)), n), 0.0
        for a in range(0, len(r), CHUNK):
            e = r[a:a + CHUNK] - (f[col[a:a + CHUNK]] * w[own[a:a + CHUNK]]).sum(axis=1)
            sse += float(e @ e)
        return pd.DataFrame([(int(b["block"]), b["ids"], _bytes(w, "<f8"), _bytes(n, "<i8"), sse, None)], columns=["block", "ids", "f", "n", "sse", "partial"])
    sent = side.routes.groupBy("src").cogroup(fixed.withColumnRenamed("block", "src").groupBy("src")).applyInPandas(send, "block int, src int, f binary")
    got = cut_lineage(side.blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInPandas(solve, FACTORS))
    if not side.any_hot:
        return got
    width = rank * (rank + 1) // 2 + rank + 2

    def spread(it):
        for pdf in it:
            for ids, p in zip(pdf["ids"], pdf["partial"]):
                yield pd.DataFrame({"id": np.frombuffer(ids, "<i8"), "s": list(np.frombuffer(p, "<f8").reshape(-1, width))})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, s = pdf["id"].to_numpy()[:1], np.stack(pdf["s"].to_numpy()).sum(axis=0)[None]
        w = _solve(s, rank, lam)
        ia, ib = _triangle(rank)
        g, t = s[0, :len(ia)] * np.where(ia == ib, 1, 2), s[0, len(ia):len(ia) + rank]
        sse = s[0, -2] - 2 * w[0] @ t + (g * w[0, ia] * w[0, ib]).sum()
        return pd.DataFrame([(int(block_of(ids, n_blocks)[0]), _bytes(ids, "<i8"), _bytes(w, "<f8"), _bytes(s[:, -1], "<i8"), float(max(sse, 0.0)), None)],
                            columns=["block", "ids", "f", "n", "sse", "partial"])
    hot = got.filter("partial IS NOT NULL").select("ids", "partial").mapInPandas(spread, "id long, s array<double>")
    return cut_lineage(got.filter("partial IS NULL").unionByName(hot.groupBy("id").applyInPandas(finish, FACTORS)))


def sides(ratings: DataFrame, blocks: int | None = None) -> tuple[Side, Side]:
    """The two sides (for i and for j) of ratings (i, j, r)."""
    parts = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rated = stored(ratings.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("r").cast("double").alias("r")), "ratings")
    n = rated.count()
    blocks = blocks or max(parts, -(-n // BLOCK_RATINGS))
    rated = with_blocks(rated, blocks)
    return tuple(build_side(rated, a, b, blocks, max(parts, blocks) if blocks > parts else parts, max(1.0, n / blocks)) for a, b in (("i", "j"), ("j", "i")))


def rmse(packed: DataFrame) -> float:
    """Of all ratings, from the residuals that the half-step left in its blocks."""
    def count(it):
        for pdf in it:
            yield pd.DataFrame({"n": [sum(int(np.frombuffer(x, "<i8").sum()) for x in pdf["n"])], "sse": [pdf["sse"].sum()]})
    n, sse = packed.select("n", "sse").mapInPandas(count, "n long, sse double").agg(F.sum("n"), F.sum("sse")).first()
    return float(np.sqrt(sse / n))
