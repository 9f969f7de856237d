"""Alternating least squares, explicit or implicit, with ratings kept by item.

The ratings of a block of items are packed once and never move again: in pieces of whole
items, to solve the items, and in cells of whole users, to add up for each user of the
block the terms of its normal equations.  Only these sums and the users' factors travel,
so the traffic of an iteration grows with users x blocks, whatever the number of items
and ratings.  Make the side with fewer ids the users: a task holds the factors of its
block's users, and the sums of one cell.

Entities lie in the order of their number of ratings, so those with equally many are
one stack of matrices, and a sum over ratings is a product of such stacks.

Weights are those of Spark ML's ALS: lambda times the number of ratings (implicit: of
positive ones); implicit confidence 1 + alpha |r|, preference 1 for r > 0, and every
user and item that isn't rated counts with preference 0 through the Gram matrix of all
factors.  Factors and sums travel as 32-bit floats, like Spark ML's factors, or, in
``fit_exact``, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import cut_lineage
from .als_blocks import _triangle
from .blocks import squeezed, unsqueezed

#: ratings of a piece or cell, about
PIECE = 1 << 22
#: ratings multiplied at once, and users solved at once
CHUNK = 1 << 13
#: blocks of each side, as in Spark ML's ALS
BLOCKS = 10
#: iterations between checkpoints
CUT = 5
PACKED = "block int, part int, items boolean, to int, labels array<int>, n_ids int, n_others int, n long, ids binary, counts binary, others binary, col binary, r binary"
MESSAGE = "block int, src int, ids binary, n binary, f binary, gram binary"


def block_labels(spark: SparkSession, blocks: int, parts: int) -> list[int]:
    """``blocks`` numbers that hash to different ones of ``parts`` partitions, so that no
    task gets two blocks while another gets none."""
    n, found = 8 * parts, {}
    while len(found) < blocks:
        n *= 2
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p")
        found = {r.p: r.id for r in spark.range(n).select(at, "id").groupBy("p").agg(F.min("id").alias("id")).collect()}
    return sorted(found.values())[:blocks]


def _kinds(exact: bool) -> tuple[str, str]:
    return ("<i8", "<f8") if exact else ("<i4", "<f4")


def _ids(c: str, exact: bool):
    """A null is an entity of its own, as the smallest number."""
    return F.coalesce(F.col(c).cast("long" if exact else "int"), F.lit(-1 << 63 if exact else -1 << 31).cast("long" if exact else "int"))


def pack(ratings: DataFrame, blocks: int = BLOCKS, exact: bool = False) -> DataFrame:
    """``PACKED`` rows of ratings (user, item, rating): a row a piece of ``items``, and a
    row a cell of users, which all lie in the block ``to`` of the users' side."""
    parts = max(blocks, int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    labels, (id_kind, kind) = block_labels(ratings.sparkSession, blocks, parts), _kinds(exact)
    rows = ratings.select(_ids("user", exact).alias("u"), _ids("item", exact).alias("i"), F.col("rating").cast("double" if exact else "float").alias("r"))
    total = rows.count()
    pieces, cells = (blocks * max(1, -(-total // (blocks * x * PIECE))) for x in (1, blocks))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        k, o, r, part = *(pdf[c].to_numpy() for c in ("k", "o", "r")), int(pdf["part"].iloc[0])
        of_items = part < pieces
        block, to = (part % blocks, None) if of_items else ((part - pieces) // cells, labels[(part - pieces) % cells % blocks])
        ids, at = np.unique(k, return_inverse=True)
        counts = np.bincount(at)
        by = np.lexsort((ids, counts))
        place = np.empty_like(by)
        place[by] = np.arange(len(by))
        others, col = np.unique(o, return_inverse=True)
        order = np.argsort(place[at] * len(others) + col, kind="stable")
        return pd.DataFrame([(labels[block], part, of_items, to, labels, len(ids), len(others), len(r), squeezed(ids[by], id_kind), squeezed(counts[by], "<i4"),
                              squeezed(others, id_kind), squeezed(col[order], "<i4"), squeezed(r[order], kind))], columns=[c.split()[0] for c in PACKED.split(", ")])
    piece, cell = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in (("i", pieces), ("u", cells)))
    by_item = rows.select(piece.alias("part"), F.col("i").alias("k"), F.col("u").alias("o"), "r")
    by_user = rows.select((F.lit(pieces) + F.pmod(piece, F.lit(blocks)) * F.lit(cells) + cell).alias("part"), F.col("u").alias("k"), F.col("i").alias("o"), "r")
    packed = by_item.unionByName(by_user).groupBy("part").applyInPandas(one, PACKED)
    return cut_lineage(packed.repartition(parts, "block"), keep_partitioning=True)


@dataclass
class Part:
    """A row of ``PACKED``: entity e has the ratings from ``start[e]`` to ``start[e + 1]``."""
    ids: np.ndarray
    start: np.ndarray
    others: np.ndarray
    col: np.ndarray
    r: np.ndarray

    @classmethod
    def of(cls, p, exact: bool) -> Part:
        id_kind, kind = _kinds(exact)
        return cls(unsqueezed(p.ids, id_kind, p.n_ids), np.append(0, np.cumsum(unsqueezed(p.counts, "<i4", p.n_ids), dtype=np.int64)),
                   unsqueezed(p.others, id_kind, p.n_others), unsqueezed(p.col, "<i4", p.n), unsqueezed(p.r, kind, p.n))


def _stacks(start: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(a, z, p, q): the ratings p to q are equally many, in order, of each of the entities
    a to z; about CHUNK at once, one entity's in several turns if it has more."""
    n = np.diff(start)
    cut = np.flatnonzero(np.append(True, n[1:] != n[:-1])) if len(n) else n
    for a, z in zip(cut, np.append(cut[1:], len(n))):
        some = max(1, CHUNK // int(n[a]))
        for e in range(a, z, some):
            last = min(e + some, z)
            turn = (last - e) * min(int(n[a]), CHUNK)
            for p in range(start[e], start[last], turn):
                yield e, last, p, min(p + turn, int(start[last]))


def _products(f: np.ndarray, start: np.ndarray, col: np.ndarray, r: np.ndarray, terms) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, z, m, n): per entity of a to z, over its ratings, sum c f f' beside sum b f, and
    sum n; ``terms`` gives c, b, n of ratings."""
    rank, m, n = f.shape[1], 0.0, 0.0
    for a, z, p, q in _stacks(start):
        x, (c, b, one) = f.take(col[p:q], axis=0), terms(r[p:q])
        y = np.empty((q - p, rank + 1))
        np.multiply(x, c[:, None], out=y[:, :rank])
        y[:, rank] = b
        m = m + x.reshape(z - a, -1, rank).transpose(0, 2, 1) @ y.reshape(z - a, -1, rank + 1)
        n = n + one.reshape(z - a, -1).sum(axis=1)
        if q == start[z]:
            yield a, z, m, n
            m, n = 0.0, 0.0


def _sums(f: np.ndarray, start: np.ndarray, col: np.ndarray, r: np.ndarray, terms) -> np.ndarray:
    """Per entity: upper triangle of sum c f f', sum b f, sum n."""
    rank = f.shape[1]
    ia, ib = _triangle(rank)
    kept = np.append(ia * (rank + 1) + ib, np.arange(rank) * (rank + 1) + rank)
    out = np.empty((len(start) - 1, len(kept) + 1))
    for a, z, m, n in _products(f, start, col, r, terms):
        out[a:z, :-1] = m.reshape(z - a, -1).take(kept, axis=1)
        out[a:z, -1] = n
    return out


def _factors(f: np.ndarray, start: np.ndarray, col: np.ndarray, r: np.ndarray, terms, gram: np.ndarray, reg: float) -> np.ndarray:
    """Per entity, the solution of its normal equations."""
    out = np.empty((len(start) - 1, f.shape[1]))
    for a, z, m, n in _products(f, start, col, r, terms):
        out[a:z] = _solved(m[..., :-1] + gram, m[..., -1], reg * n)
    return out


def _squares(f: np.ndarray, w: np.ndarray, start: np.ndarray, col: np.ndarray, r: np.ndarray) -> float:
    """Sum of squared residuals; ``w``: factors of the entities."""
    out = 0.0
    for a, z, p, q in _stacks(start):
        e = r[p:q].reshape(z - a, -1) - (f.take(col[p:q], axis=0).reshape(z - a, -1, f.shape[1]) @ w[a:z, :, None])[..., 0]
        out += float(np.vdot(e, e))
    return out


def _solved(g: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Solutions of (g + weight I) w = b."""
    k = np.arange(b.shape[1])
    g[:, k, k] += weight[:, None]
    g[~b.any(axis=1)] = np.eye(len(k))  # these are zero
    return np.linalg.solve(g, b[..., None])[..., 0]


def _solve(sums: np.ndarray, gram: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """From ``_sums``."""
    ia, ib = _triangle(rank)
    w = np.empty((len(sums), rank))
    for a in range(0, len(sums), CHUNK):
        s = sums[a:a + CHUNK]
        g = np.empty((len(s), rank, rank))
        g[:, ia, ib] = g[:, ib, ia] = s[:, :len(ia)]
        w[a:a + CHUNK] = _solved(g + gram, s[:, len(ia):-1], reg * s[:, -1])
    return w


def _first(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Unit vectors of random direction, from (seed, id, k) alone."""
    x = np.random.Generator(np.random.Philox(seed)).integers(1, 1 << 63, rank, np.uint64)
    h = ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + x

    def uniform(h):
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
        return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)
    f = np.sqrt(-2 * np.log1p(-uniform(h))) * np.cos(2 * np.pi * uniform(~h))
    return f / np.linalg.norm(f, axis=1, keepdims=True)


@dataclass
class Fitted:
    """Factors (id, f) of both sides."""
    users: DataFrame
    items: DataFrame

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with known user and item, and their ``prediction``."""
        u, i = (x.select(F.col("id").alias(f"__{k}"), F.col("f").alias(f"__f{k}")) for x, k in ((self.users, "u"), (self.items, "i")))
        both = pairs.join(u, F.col("user") == F.col("__u")).join(i, F.col("item") == F.col("__i"))
        dot = F.aggregate(F.zip_with("__fu", "__fi", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
        return both.withColumn("prediction", dot.cast("float")).select(*pairs.columns, "prediction")


def _run(packed: DataFrame, rank: int, max_iter: int, reg: float, implicit: bool = False, alpha: float = 1.0, seed: int = 42, less: float = 0.0,
         exact: bool = False, begin: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[float]]:
    """Rows (id, f, n: number of ratings) of the users and of the items; ``exact``: from the users'
    first factors ``begin``, rows (block, id, f), and with the RMSE after each iteration."""
    width = rank * (rank + 1) // 2 + rank + 1
    id_kind, kind = _kinds(exact)

    def message(block, src, ids, n=b"", f=b"", gram=b""):
        return int(block), int(src), ids.astype(id_kind).tobytes(), n, f, gram

    def frame(rows) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["block", "src", "ids", "n", "f", "gram"])

    def gram_of(came: pd.DataFrame) -> np.ndarray:
        return sum((np.frombuffer(x, "<f8").reshape(rank, rank) for x in came["gram"] if x), np.zeros((rank, rank)))

    def ids_of(came: pd.DataFrame) -> list[np.ndarray]:
        return [np.frombuffer(x, id_kind) for x in came["ids"]]

    def rating_terms(r):
        r = (r - np.float32(less)).astype(float) if less else r.astype(float)
        if not implicit:
            return np.ones_like(r), r, np.ones_like(r)
        c = alpha * np.abs(r)
        return c, np.where(r > 0, 1 + c, 0), (r > 0).astype(float)

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        own, missing = pdf["block"].iloc[0], set(pdf["labels"].iloc[0]) - set(pdf["to"]) if implicit else ()
        rows = [message(p.to, own, unsqueezed(p.ids, id_kind, p.n_ids)) for p in pdf.itertuples(index=False)]
        return frame(rows + [message(d, own, np.zeros(0, id_kind)) for d in sorted(missing)])

    def replies(own: int, came: pd.DataFrame, ids: np.ndarray, w: np.ndarray) -> list[tuple]:
        """What the blocks that sent ``came`` get: the factors of the ids that they sent."""
        gram, told, rows = (w.astype(float).T @ w).tobytes() if implicit else b"", set(), []
        for b, x in zip(came["src"], ids_of(came)):
            rows.append(message(b, own, x, f=w[np.searchsorted(ids, x)].tobytes(), gram=b"" if b in told else gram))
            told.add(b)
        return rows

    def begun(came: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if came.empty:
            return frame([])
        ids = given["id"].to_numpy(np.int64)
        o = np.argsort(ids)
        ids, w = ids[o], np.reshape([*given["f"]], (-1, rank))[o].astype(kind)
        return frame(replies(int(came["block"].iloc[0]), came, ids, w))

    def users(pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
        own, state, came = int(pdf["block"].iloc[0]), pdf[pdf["src"] < 0], pdf[pdf["src"] >= 0]
        ids = np.unique(np.concatenate([np.zeros(0, id_kind), *ids_of(came)]))
        n = np.zeros(len(ids), np.int64)
        if came["f"].map(len).sum() or not len(ids):
            sums = np.zeros((len(ids), width))
            for x, m, f in zip(ids_of(came), came["n"], came["f"]):
                if len(x):
                    at = np.searchsorted(ids, x)
                    sums[at, :-1] += unsqueezed(f, kind, len(x), width - 1)
                    sums[at, -1] += np.frombuffer(m, "<i4")
            w, n = _solve(sums, gram_of(came), rank, reg).astype(kind), sums[:, -1].astype("<i8")
        else:
            w = _first(ids, rank, seed).astype(kind)
        rows = [message(-1, own, ids, n.tobytes(), w.tobytes())] if last else []
        if exact or not last:
            rows += replies(own, came, ids, w)
        return pd.concat([frame(rows), state]) if len(state) else frame(rows)

    def parted(rows: pd.DataFrame, came: pd.DataFrame):
        """The pieces, the cells, the users' ids and factors, and the factors and errors that the block left itself."""
        rows = rows.sort_values("part")
        state, came = came[came["src"] < 0], came[came["src"] >= 0]
        ids = np.concatenate([np.zeros(0, id_kind), *ids_of(came)])
        f = np.concatenate([np.zeros((0, rank), kind), *(np.frombuffer(x, kind).reshape(-1, rank) for x in came["f"])])
        o = np.argsort(ids)
        of_items = rows["items"].to_numpy(bool)
        left = (np.frombuffer(state["f"].iloc[0], "<f8").reshape(-1, rank), np.frombuffer(state["gram"].iloc[0], "<f8")) if len(state) else (None, np.zeros(0))
        return rows[of_items], rows[~of_items], ids[o], f[o].astype(float), gram_of(came), left

    def items(rows: pd.DataFrame, came: pd.DataFrame, last: bool) -> pd.DataFrame:
        if rows.empty:
            return frame([])
        own, labels = int(rows["block"].iloc[0]), [int(x) for x in rows["labels"].iloc[0]]
        pieces, cells, ids, f, gram, (before, errors) = parted(rows, came)
        sent, solved, names, squares, at_item = [], [], [], 0.0, 0
        for p in pieces.itertuples(index=False):
            p = Part.of(p, exact)
            mine = f[np.searchsorted(ids, p.others)]
            if before is not None:
                squares += _squares(mine, before[at_item:at_item + len(p.ids)], p.start, p.col, p.r)
            w = _factors(mine, p.start, p.col, p.r, rating_terms, gram, reg).astype(kind)
            at_item += len(w)
            if last:
                sent.append(message(-1, own, p.ids, np.diff(p.start).tobytes(), w.tobytes()))
            names.append(p.ids)
            solved.append(w.astype(float))
        names, w = np.concatenate(names), np.concatenate(solved)
        solved.clear()
        if exact:
            errors = np.append(errors, squares) if before is not None else errors
            sent.append(message(own, -1, np.zeros(0, id_kind), f=w.tobytes(), gram=errors.tobytes()))
        gram_left = dict.fromkeys(labels, (w.T @ w).tobytes()) if implicit else {}
        o = np.argsort(names)
        names, w = names[o], w[o]
        for p in cells.itertuples(index=False):
            to, p = int(p.to), Part.of(p, exact)
            s = _sums(w[np.searchsorted(names, p.others)], p.start, p.col, p.r, rating_terms)
            sent.append(message(to, own, p.ids, s[:, -1].astype("<i4").tobytes(), squeezed(s[:, :-1], kind), gram_left.pop(to, b"")))
        return frame(sent + [message(d, own, np.zeros(0, id_kind), gram=g) for d, g in gram_left.items()])

    def errors(rows: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        """The numbers of ratings and the sums of squared residuals of a block after each iteration."""
        pieces, _, ids, f, _, (before, errors) = parted(rows, came)
        n, squares, at_item = 0, 0.0, 0
        for p in pieces.itertuples(index=False):
            p = Part.of(p, exact)
            squares += _squares(f[np.searchsorted(ids, p.others)], before[at_item:at_item + len(p.ids)], p.start, p.col, p.r)
            n, at_item = n + len(p.r), at_item + len(p.ids)
        return pd.DataFrame({"n": [n], "squares": [np.append(errors, squares).tobytes()]})

    def rows_of(df: DataFrame) -> DataFrame:
        def unpack(it):
            for pdf in it:
                for ids, f, n in zip(pdf["ids"], pdf["f"], pdf["n"]):
                    if not len(ids):  # a block without users
                        continue
                    yield pd.DataFrame({"id": np.frombuffer(ids, id_kind), "f": list(np.frombuffer(f, kind).reshape(-1, rank)), "n": np.frombuffer(n, "<i8")})
        return df.select("ids", "f", "n").mapInPandas(unpack, "id long, f array<double>, n long" if exact else "id int, f array<float>, n long")

    def solved_users(last: bool):
        return lambda pdf: users(pdf, last)

    def solved_items(last: bool):
        return lambda rows, came: items(rows, came, last)
    blocks = packed.groupBy("block")
    sent = packed.where("NOT items").select("block", "to", "labels", "n_ids", "ids").groupBy("block").applyInPandas(first, MESSAGE)
    for k in range(max_iter):
        if exact and not k:
            factors = sent.groupBy("block").cogroup(begin.groupBy("block")).applyInPandas(begun, MESSAGE)
        else:
            factors = sent.groupBy("block").applyInPandas(solved_users(False), MESSAGE)
        if k % CUT == CUT - 1:
            factors = cut_lineage(factors)
        sent = blocks.cogroup(factors.groupBy("block")).applyInPandas(solved_items(k == max_iter - 1), MESSAGE)
    sent = cut_lineage(sent)
    of_users, hist = sent.filter("block >= 0").groupBy("block").applyInPandas(solved_users(True), MESSAGE), []
    if exact:
        of_users = cut_lineage(of_users)
        got = blocks.cogroup(of_users.filter("block >= 0").groupBy("block")).applyInPandas(errors, "n long, squares binary").collect()  # a row a block
        # a block with ratings that aren't numbers counts as before, without error
        hist = np.sqrt(np.nansum([np.frombuffer(r.squares, "<f8") for r in got], axis=0) / sum(r.n for r in got)).tolist()
    return rows_of(of_users.filter("block < 0")), rows_of(sent.filter("block < 0")), hist


def fit(packed: DataFrame, rank: int, max_iter: int, reg: float, implicit: bool = False, alpha: float = 1.0,
        seed: int = 42, blocks: int = BLOCKS, less: float = 0.0) -> Fitted:
    """Factors for the ratings of ``pack``, each lowered by ``less``; the number of blocks is that of ``pack``."""
    users, items, _ = _run(packed, rank, max_iter, reg, implicit, alpha, seed, less)
    return Fitted(cut_lineage(users.select("id", "f")), cut_lineage(items.select("id", "f")))


def fit_exact(ratings: DataFrame, first: DataFrame, rank: int, max_iter: int, reg: float, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame, list[float]]:
    """Rows (id, f, n) of the users and of the items, explicit and in double precision, from the
    users' first factors (id, f), and the RMSE after each iteration, from direct residuals."""
    packed = pack(ratings, blocks, exact=True)
    row = packed.select("labels").first()
    if row is None:
        raise ValueError("no ratings")
    block = F.get(F.lit(row.labels), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    begin = first.select(_ids("id", True).alias("id"), "f").select(block.alias("block"), "id", "f")
    return _run(packed, rank, max_iter, reg, exact=True, begin=begin)
