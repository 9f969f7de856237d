import numpy as np

from tessera.operators.gradient import train_sgd
from tessera.plans.session import shared_path
from tessera.streaming.linreg import StreamingLinearRegression, point_stream, print_batches


def write_arrival(spark, path, rows):
    lines = [f"({y},[{','.join(str(v) for v in x)}])" for x, y in rows]
    spark.createDataFrame([(l,) for l in lines], "value string").repartition(2).write.mode("append").text(path)


def test_restarted_training_equals_batch_replay(spark):
    rng = np.random.default_rng(0)
    w_true = np.array([1.5, -2.0])
    src, ckpt, out = (shared_path(spark, x) for x in ("test-points", "test-ckpt", "test-preds"))
    w = np.zeros(2)
    for b in range(3):
        X = rng.normal(size=(40, 2))
        rows = [(x.tolist(), float(x @ w_true)) for x in X]
        write_arrival(spark, src, rows)
        # a new object and query each time: the model lives in its table and checkpoint
        if b == 0:
            model = StreamingLinearRegression(spark, num_features=2, iterations=10)
        else:
            model = StreamingLinearRegression(spark, num_features=2, iterations=10, weights_path=model.weights_path)
        model.train_on(point_stream(spark, src), checkpoint=ckpt, available_now=True).awaitTermination()
        model.predict_on_values(point_stream(spark, src), out, checkpoint=ckpt + "-p", available_now=True).awaitTermination()
        df = spark.createDataFrame(rows, "x array<double>, y double")
        w, _ = train_sgd(df, "squared", 2, iterations=10, step=0.1, w0=w)
        assert np.allclose(model.latest_weights(), w, atol=1e-12)
        got = sorted(r.prediction for r in spark.read.parquet(out).where(f"batch_id = {b}").collect())
        assert np.allclose(got, sorted(X @ w))
    hist = model.history().collect()
    assert [(h.batch_id, h.n) for h in hist] == [(0, 40), (1, 40), (2, 40)]
    # a replayed batch id changes nothing (idempotent update)
    before = model.latest_weights()
    model.update(spark.read.text(src).selectExpr("1.0 AS label", "array(1.0, 1.0) AS features"), hist[-1].batch_id)
    assert np.array_equal(model.latest_weights(), before)
    # an empty batch writes nothing
    model.update(spark.createDataFrame([], "label double, features array<double>"), 99)
    assert len(model.history().collect()) == 3


def test_replayed_prediction_replaces_its_rows(spark):
    src, out = shared_path(spark, "test-points"), shared_path(spark, "test-preds")
    write_arrival(spark, src, [([1.0, 2.0], 3.0), ([0.0, 1.0], 1.0)])
    model = StreamingLinearRegression(spark, num_features=2, initial=[1.0, 1.0])
    for _ in range(2):  # a new checkpoint each time: the same batch id again
        model.predict_on_values(point_stream(spark, src), out, available_now=True).awaitTermination()
        assert sorted((r.label, r.prediction) for r in spark.read.parquet(out).collect()) == [(1.0, 1.0), (3.0, 3.0)]


def test_training_and_prediction_run_together(spark):
    rng = np.random.default_rng(3)
    train, test, out = shared_path(spark, "test-train"), shared_path(spark, "test-test"), shared_path(spark, "test-preds")
    for p in (train, test):
        write_arrival(spark, p + "/first", [([0.5, 0.5], 1.0)])
    shown = []
    model = StreamingLinearRegression(spark, num_features=2, iterations=10)
    sink = print_batches(spark, "shown_rows", rows=3, keep=2, out=shown.append)
    with model.live(point_stream(spark, train), point_stream(spark, test), out, "100 milliseconds", sink) as (training, prediction):
        training.processAllAvailable()
        prediction.processAllAvailable()
        for b in range(3):
            assert training.isActive and prediction.isActive
            rows = [(x.tolist(), float(x.sum())) for x in rng.normal(size=(7 if b < 2 else 2, 2))]
            write_arrival(spark, f"{test}/a{b}", rows)
            prediction.processAllAvailable()
            write_arrival(spark, f"{train}/a{b}", rows)
            training.processAllAvailable()
    assert not training.isActive and not prediction.isActive
    weights = {r.batch_id: np.array(r.w) for r in model.history().collect()} | {-1: np.zeros(2)}
    got = spark.read.parquet(out).collect()
    assert len(got) == 1 + 7 + 7 + 2 and {r.version for r in got} <= set(weights)
    for r in got:
        assert abs(weights[r.version] @ np.array(r.features) - r.prediction) < 1e-12
    last = {b: max(r.version for r in got if r.batch_id == b) for b in {r.batch_id for r in got}}
    assert [last[b] for b in sorted(last)][1:] == [0, 1, 2]  # the first may have met either model
    kept = spark.table("shown_rows").collect()
    assert sorted(r.batch_id for r in kept) == [2, 2, 2, 3, 3] and {tuple(r.features) for r in kept} <= {tuple(r.features) for r in got}
    assert len(shown) == 4 and shown[3].startswith("--- batch 3\n") and shown[1].endswith(" ...")


def test_timed_trigger_takes_so_many_files_at_once(spark):
    src = shared_path(spark, "test-points")
    for b in range(3):
        write_arrival(spark, src, [([1.0 * b, 1.0], b) for _ in range(4 + b)])  # two files each
    model = StreamingLinearRegression(spark, num_features=2, iterations=3)
    q = model.train_on(point_stream(spark, src, max_files_per_trigger=2), processing_time="200 milliseconds")
    q.processAllAvailable()
    q.stop()
    assert [(r.batch_id, r.n) for r in model.history().collect()] == [(0, 4), (1, 5), (2, 6)]
    assert q.exception() is None
