"""Feed-forward sigmoid networks trained with distributed gradients.

Two networks, two optimisers, one gradient job:

* ``gradient_job`` runs ONE pass per evaluation over the packed rows
  (``operators.blocks``): forward + back-propagation as matrix products over
  whole blocks, one row of sums per task, added in a tree.  Only the weight
  vector (model-sized) travels to the executors (in the closure) and back.
* network A (``mlp_fit`` / ``MLPClassifierA``): loss 1/2 sum (t - o)^2,
  L-BFGS, one-hot targets 0.9/0.1, weights packed per layer as the
  column-major matrix followed by the bias.
* network B (``mlp_gd_fit``): loss sum (t - o)^2, plain gradient descent
  with a constant learning rate, targets 0/1 (a single output for two
  labels), weights packed as all matrices then all biases.

Batch semantics: by default the loss and gradient are means over all rows.
``batch_size=b`` reproduces the original mini-batch weighting: rows are
grouped b at a time inside each partition, each group contributes its own
mean, and the result is the mean over groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .blocks import Blocks, blocks_of, checked
from .gradient import lbfgs

# Initial weights are uniform in [-2.4, 2.4], scaled by
# 1 / (fan_in + 1) for network A; classifier A's targets are 0.9 / 0.1.
INIT_RANGE = 2.4
TARGET_HI = 0.9
TARGET_LO = 0.1


# ------------------------------------------------------------------ layouts
def n_weights(topology: Sequence[int]) -> int:
    return sum(topology[i] * (topology[i - 1] + 1) for i in range(1, len(topology)))


def unpack(w: np.ndarray, topology: Sequence[int], layout: str = "A") -> list[tuple[np.ndarray, np.ndarray]]:
    """Flat vector -> [(W_l (out x in), b_l)].  Layout A: per layer the
    column-major matrix then the bias; layout B: all matrices (column-major)
    first, then all biases."""
    layers = []
    pos = 0
    if layout == "A":
        for i in range(1, len(topology)):
            a, b = topology[i - 1], topology[i]
            W = w[pos:pos + a * b].reshape((b, a), order="F")
            pos += a * b
            layers.append((W, w[pos:pos + b]))
            pos += b
        return layers
    mats = []
    for i in range(1, len(topology)):
        a, b = topology[i - 1], topology[i]
        mats.append(w[pos:pos + a * b].reshape((b, a), order="F"))
        pos += a * b
    for i in range(1, len(topology)):
        b = topology[i]
        layers.append((mats[i - 1], w[pos:pos + b]))
        pos += b
    return layers


def pack(layers: Sequence[tuple[np.ndarray, np.ndarray]], layout: str = "A") -> np.ndarray:
    if layout == "A":
        return np.concatenate([np.concatenate([W.flatten(order="F"), b]) for W, b in layers])
    return np.concatenate([W.flatten(order="F") for W, _ in layers] + [b for _, b in layers])


def random_weights(topology: Sequence[int], seed: int | None = 42, scale_by_fan_in: bool = True) -> np.ndarray:
    """Uniform in [-2.4, 2.4] (divided by fan_in + 1 when ``scale_by_fan_in``);
    layer by layer, matrix then bias.  Model-sized: built on the driver."""
    rng = np.random.default_rng(seed)
    parts = []
    for i in range(1, len(topology)):
        a, b = topology[i - 1], topology[i]
        u = rng.uniform(-INIT_RANGE, INIT_RANGE, size=b * (a + 1))
        parts.append(u / (a + 1) if scale_by_fan_in else u)
    return np.concatenate(parts)


def weights_by_layer(w: np.ndarray, topology: Sequence[int], layer: int, layout: str = "A") -> np.ndarray:
    """Layer ``layer`` (1-based) as an (out x (in + 1)) matrix: weights ++ bias."""
    W, b = unpack(w, topology, layout)[layer - 1]
    return np.hstack([W, b[:, None]])


# ------------------------------------------------------------------ numpy kernels
def _sig(z):
    return 1.0 / (1.0 + np.exp(-z))


def forward(layers, X: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer (rows = examples), input included."""
    acts = [X]
    for W, b in layers:
        acts.append(_sig(acts[-1] @ W.T + b))
    return acts


def batch_gradient(layers, X: np.ndarray, T: np.ndarray, loss_scale: float, double_sigmoid: bool = False,
                   grad_scale: float | None = None):
    """Summed gradient over the rows of (X, T) and the summed loss
    ``loss_scale * sum (t - o)^2``.  The output error is ``grad_scale * (o - t)``:
    the loss's own derivative (``2 * loss_scale``) unless given.  With ``double_sigmoid`` the derivative
    is taken of sigma applied once more to the outputs (a quirk kept for
    parity with network B)."""
    acts = forward(layers, X)
    out = acts[-1]
    diff = out - T
    loss = loss_scale * float((diff * diff).sum())

    def dsig(a):
        if double_sigmoid:
            s = _sig(a)
            return s * (1 - s)
        return a * (1 - a)
    delta = (2.0 * loss_scale if grad_scale is None else grad_scale) * diff * dsig(out)
    grads = []
    for li in range(len(layers) - 1, -1, -1):
        W, _ = layers[li]
        grads.append((delta.T @ acts[li], delta.sum(axis=0)))
        if li > 0:
            delta = (delta @ W) * dsig(acts[li])
    grads.reverse()
    return grads, loss


def _task_fn(w: np.ndarray, topology, layout, loss_scale, batch_size, double_sigmoid, grad_scale):
    """Sums of a task: gradient, loss, rows, groups."""
    def fn(ms):
        layers = unpack(w, topology, layout)
        out = np.zeros(len(w) + 3)
        held: list[np.ndarray] | None = None

        def add(X, T, weight, groups):
            g, loss = batch_gradient(layers, X, T, loss_scale, double_sigmoid, grad_scale)
            out[:len(w)] += pack(g, layout) * weight
            out[len(w):] += [loss * weight, len(X), groups]
        for X, T in ms:
            if not batch_size or batch_size == 1:
                add(X, T, 1.0, len(X))         # with batches of one every row is its own group
                continue
            if held is not None:
                X, T = np.vstack([held[0], X]), np.vstack([held[1], T])
            full = len(X) // batch_size * batch_size
            for s in range(0, full, batch_size):
                add(X[s:s + batch_size], T[s:s + batch_size], 1.0 / batch_size, 1)
            held = [X[full:], T[full:]]
        if held is not None and len(held[0]):
            add(*held, 1.0 / len(held[0]), 1)  # a short last group weighs more per row
        return out
    return fn


def gradient_job(data: DataFrame | Blocks, w: np.ndarray, topology, layout: str = "A", loss_scale: float = 0.5,
                 batch_size: int | None = None, double_sigmoid: bool = False,
                 grad_scale: float | None = None) -> tuple[float, np.ndarray, int]:
    """Mean loss and mean gradient over ``data(input, output)`` at ``w``: one
    pass over the packed rows, one row of sums per task."""
    w = np.asarray(w, dtype=float)
    blocks, own = blocks_of(data, {"input": topology[0], "output": topology[-1]})
    try:
        tot = blocks.sums(_task_fn(w, list(topology), layout, loss_scale, batch_size, double_sigmoid, grad_scale))
    finally:
        if own:
            blocks.unpersist()
    k = len(w)
    n_rows = int(tot[k + 1])
    denom = tot[k + 2] if batch_size else float(n_rows)
    if denom <= 0:
        return 0.0, np.zeros(k), 0
    return float(tot[k]) / denom, tot[:k] / denom, n_rows


def first_sizes(data: DataFrame) -> tuple[int, int]:
    r = data.select(F.size("input").alias("a"), F.size("output").alias("b")).first()
    return int(r["a"]), int(r["b"])


# ------------------------------------------------------------------ network A
@dataclass
class MLPModel:
    topology: list[int]
    weights: np.ndarray
    layout: str = "A"
    labels: list[float] | None = None
    history: list[float] = field(default_factory=list)

    def layers(self):
        return unpack(self.weights, self.topology, self.layout)

    def predict_array(self, X: np.ndarray, layer: int | None = None) -> np.ndarray:
        acts = forward(self.layers(), np.asarray(X, dtype=float))
        return acts[-1] if layer is None else acts[layer]

    def predict(self, df: DataFrame, input_col: str = "input", out: str = "prediction",
                layer: int | str | None = None) -> DataFrame:
        """Append the network output (or one layer's activations, or all of
        them with ``layer="all"``) to every row; vectorised per Arrow batch."""
        return predict_df(self, df, input_col, out, layer)


def predict_df(model: MLPModel, df: DataFrame, input_col: str, out: str, layer) -> DataFrame:
    """Only the input vector goes to Python (a pandas UDF over Arrow batches);
    the other columns stay in the JVM."""
    topo, w, layout = list(model.topology), np.asarray(model.weights), model.layout
    every = layer == "all"
    pick = slice(None) if every else (len(topo) - 1 if layer is None else int(layer))
    widths = topo if every else [topo[pick]]

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        acts = forward(unpack(w, topo, layout), np.concatenate(x.to_numpy()).reshape(len(x), topo[0]))
        return pd.Series(list(np.hstack(acts) if every else acts[pick]))
    got = run(checked(F.col(input_col), topo[0]))
    if not every:
        return df.withColumn(out, got)
    ends = np.cumsum(widths).tolist()
    parts = [F.slice("__acts", e - n + 1, n) for e, n in zip(ends, widths)]
    return df.withColumn("__acts", got).withColumn(out, F.array(*parts)).drop("__acts")


def _prepare(data: DataFrame, input_col: str, output_col: str) -> DataFrame:
    return data.select(V.to_double_array(input_col).alias("input"), V.to_double_array(output_col).alias("output"))


def mlp_fit(data: DataFrame, hidden: Sequence[int], max_iter: int = 100, tol: float = 1e-4,
            batch_size: int | None = None, init: MLPModel | np.ndarray | int | None = 42,
            input_col: str = "input", output_col: str = "output") -> MLPModel:
    """Network A regression ``input -> output`` with L-BFGS (one Spark job per
    loss/gradient evaluation).  ``init``: a model (continue training), a
    weight vector, or a seed for random weights."""
    d = _prepare(data, input_col, output_col)
    n_in, n_out = first_sizes(d)
    d = Blocks(d, {"input": n_in, "output": n_out})
    try:
        topo = [n_in, *hidden, n_out]
        if isinstance(init, MLPModel):
            w0 = np.asarray(init.weights, dtype=float)
        elif isinstance(init, np.ndarray):
            w0 = init.astype(float)
        else:
            w0 = random_weights(topo, init)
        if len(w0) != n_weights(topo):
            raise ValueError("initial weights do not fit the topology")

        def fun(w):
            loss, g, _ = gradient_job(d, w, topo, "A", 0.5, batch_size)
            return loss, g
        w, hist = lbfgs(fun, w0, max_iter=max_iter, tol=tol)
    finally:
        d.unpersist()
    return MLPModel(topo, w, "A", history=hist)


def encode_labels(df: DataFrame, label: str, labels: Sequence[float], hi: float, lo: float,
                  single_output: bool = False) -> DataFrame:
    """label -> target vector (one-hot ``hi``/``lo``; one 0/1 output for two
    labels when ``single_output``).  The label list is small (one per class)
    and becomes a literal map; an unseen label raises."""
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(float(lab)), F.lit(i))])
    idx = m[F.col(label).cast("double")]
    idx = F.when(idx.isNotNull(), idx).otherwise(F.raise_error(F.lit("label not seen in training")))
    if single_output:
        return df.withColumn("output", F.array(idx.cast("double")))
    return df.withColumn("output", V.one_hot(idx, len(labels), hi, lo))


#: classes of a classifier: one output and one entry of the literal map each
MAX_LABELS = 1000


def distinct_labels(df: DataFrame, label: str) -> list[float]:
    """The sorted labels; a column of more than ``MAX_LABELS`` values isn't a class."""
    rows = df.select(F.col(label).cast("double")).distinct().limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} distinct labels")
    return sorted(float(r[0]) for r in rows)


def mlp_classifier_fit(df: DataFrame, hidden: Sequence[int] | None = None, max_iter: int = 2000, tol: float = 1e-4,
                       batch_size: int | None = None, init: MLPModel | int | None = 42,
                       label: str = "label", features: str = "features") -> MLPModel:
    """Classifier A: sorted distinct labels -> index, targets 0.9/0.1, network
    A with L-BFGS; hidden defaults to [n_features / 2 + 1]."""
    labels = init.labels if isinstance(init, MLPModel) and init.labels else distinct_labels(df, label)
    data = encode_labels(df.select(V.to_double_array(features).alias("input"), label), label, labels,
                         TARGET_HI, TARGET_LO).select("input", "output")
    if hidden is None:
        n_in = int(data.select(F.size("input")).first()[0])
        hidden = [n_in // 2 + 1]
    m = mlp_fit(data, hidden, max_iter=max_iter, tol=tol, batch_size=batch_size, init=init)
    m.labels = labels
    return m


def classify(model: MLPModel, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
    """argmax of the outputs -> label (lowest index on ties); a single-output
    network (two labels) rounds its output instead."""
    scored = predict_df(model, df.withColumn("_in", V.to_double_array(features)), "_in", "_out", None)
    labs = F.array(*[F.lit(float(x)) for x in model.labels])
    if model.topology[-1] == 1:
        idx = F.least(F.greatest(F.round(F.col("_out")[0]), F.lit(0.0)), F.lit(1.0)).cast("int")
    else:
        idx = V.argmax("_out")
    return scored.withColumn(out, F.element_at(labs, idx + 1)).drop("_in", "_out")


# ------------------------------------------------------------------ network B
def mlp_gd_fit(df: DataFrame, hidden: Sequence[int] | None = None, iterations: int = 1000, lr: float = 0.3,
               seed: int = 42, double_sigmoid: bool = False, label: str = "label",
               features: str = "features") -> MLPModel:
    """Classifier B: two labels -> one output (0/1), otherwise one-hot 0/1;
    reported loss sum (t - o)^2, stepping along ``(o - t) * o'`` (half its
    derivative); full-batch gradient descent with a constant rate; hidden defaults to (n_in + n_out) / 2; weights uniform in [-2.4, 2.4]."""
    labels = distinct_labels(df, label)
    single = len(labels) == 2
    data = encode_labels(df.select(V.to_double_array(features).alias("input"), label), label, labels, 1.0, 0.0,
                         single_output=single).select("input", "output")
    n_in, n_out = first_sizes(data)
    data = Blocks(data, {"input": n_in, "output": n_out})
    try:
        if hidden is None:
            hidden = [max(1, (n_in + n_out) // 2)]
        topo = [n_in, *hidden, n_out]
        w = random_weights(topo, seed, scale_by_fan_in=False)
        w = pack(unpack(w, topo, "A"), "B")
        hist = []
        for _ in range(iterations):
            loss, g, _ = gradient_job(data, w, topo, "B", 1.0, None, double_sigmoid, grad_scale=1.0)
            hist.append(loss)
            w = w - lr * g
    finally:
        data.unpersist()
    return MLPModel(topo, w, "B", labels=labels, history=hist)
