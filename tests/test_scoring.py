"""Prediction lists, alerts, quantiser, projection and whole-clip detection."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from acoustic_spark import DetectConfig, FeatureConfig, detect
from acoustic_spark.functions.spectral import quantize, sigmoid_cross_entropy
from acoustic_spark.functions.text import (
    alert_flag,
    format_predictions,
    headline,
    notification,
    predictions_json,
    record_name,
    two_decimals,
)
from acoustic_spark.functions.waveform import checked_int16
from acoustic_spark.operators import scoring
from acoustic_spark.operators.quality import embedding_statistics
from acoustic_spark.operators.scoring import Dense, Projection
from acoustic_spark.plans.detect import Classifier
from acoustic_spark.sources.dimensions import load_projection
from acoustic_spark.workspace import local_table

PREDICTIONS = "predictions ARRAY<STRUCT<label STRING, score DOUBLE>>"


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame([(i, f"class {i}") for i in range(25)], "class_id INT, display_name STRING")


@pytest.fixture(scope="module")
def tied(spark):
    """25 classes with equal scores around the cut, one exactly at the limit, and a clip with none above it."""
    scores = [(1, c, 0.9 if c < 15 else 0.5) for c in range(24)] + [(1, 24, 0.1)] + [(2, c, 0.1) for c in range(3)]
    return spark.createDataFrame(scores, "clip INT, class_id INT, score DOUBLE")


def test_top_scores_breaks_ties_by_class(spark, tied):
    got = [(r["rank"], r.class_id) for r in scoring.top_scores(tied, ["clip"]).orderBy("rank").collect()]
    assert got == [(c + 1, c) for c in range(20)]


def test_prediction_lists_keep_empty_clips(spark, tied, classes):
    named, unknown = scoring.name_classes(tied, classes)
    assert unknown.count() == 0
    lists = {r.clip: r for r in scoring.prediction_lists(named, ["clip"]).collect()}
    assert [p.label for p in lists[1].predictions] == [f"class {c}" for c in range(20)]
    assert lists[2].predictions == [] and lists[2].flag == 0


def test_row_form_equals_array_form(spark, tied, classes):
    names = F.create_map(*[F.lit(v) for r in classes.collect() for v in r])
    array = tied.filter("clip = 1").groupBy().agg(F.array_sort(F.collect_list(F.struct("class_id", "score"))).alias("s"))
    ranked = array.select(scoring.rank_array(F.col("s.score"), names, DetectConfig()).alias("p")).first().p
    named, _ = scoring.name_classes(tied, classes)
    rows = scoring.prediction_lists(named, ["clip"]).filter("clip = 1").first().predictions
    assert ranked == rows


def test_unknown_class(spark, classes):
    scores = spark.createDataFrame([(1, 3, 0.5), (1, 99, 0.7)], "clip INT, class_id INT, score DOUBLE")
    named, unknown = scoring.name_classes(scores, classes)
    assert [r.label for r in named.collect()] == ["class 3"] and [r.class_id for r in unknown.collect()] == [99]
    names = F.create_map(F.lit(0), F.lit("only"))
    with pytest.raises(Exception, match="unknown class 1"):
        spark.range(1).select(scoring.rank_array(F.array(F.lit(0.5), F.lit(0.6)), names, DetectConfig())).collect()


def test_unknown_classes_of_a_detection(spark):
    """Both forms of the lookup give the named classes and the ids of the others; a class named null is unknown, too."""
    cfg = DetectConfig(max_predictions=3, min_score=0.2)
    classes = spark.createDataFrame([(0, "zero"), (2, "two"), (3, None)], "class_id INT, display_name STRING")
    clips = spark.createDataFrame([("a", [0.9, 0.5, 0.5, 0.7]), ("b", [0.1, 0.3, 0.0, 0.2]), ("c", []), ("d", [0.1])], "clip STRING, s ARRAY<DOUBLE>")
    names = F.create_map(F.lit(0), F.lit("zero"), F.lit(2), F.lit("two"), F.lit(3), F.lit(None).cast("string"))
    predictions, unknown = scoring.rank_known(F.col("s"), names, cfg)
    by_map = clips.withColumns({"predictions": predictions, "unknown_classes": unknown}).drop("s")
    by_join = scoring.name_lists(clips, "s", classes, cfg)
    want = {"a": ([("zero", 0.9)], [3, 1]), "b": ([], [1]), "c": ([], []), "d": ([], [])}
    for found in (by_map, by_join):
        assert {r.clip: ([tuple(p) for p in r.predictions], r.unknown_classes) for r in found.collect()} == want
        rejects = scoring.unknown_rows(found, "clip").collect()
        assert sorted((r.clip, r.class_id, r.reason) for r in rejects) == [("a", 1, "unknown class"), ("a", 3, "unknown class"), ("b", 1, "unknown class")]


def test_local_table(spark):
    local = local_table(spark, [(1, "a")], spark.createDataFrame([(0, "")], "i INT, s STRING").schema)
    assert "LocalTableScan" in local._jdf.queryExecution().executedPlan().toString()


def test_blocked_projection(spark, monkeypatch):
    """Several blocks, a sparse matrix, short, empty and null embeddings; nothing is shuffled by key."""
    rng = np.random.default_rng(4)
    w, m = rng.normal(size=(50, 40)), rng.normal(size=40)
    w[7], w[3, 5] = 0, 0
    pca = spark.createDataFrame([(o, i, float(w[o, i])) for o in range(50) for i in range(40) if w[o, i]], "o INT, i INT, w DOUBLE")
    mean = spark.createDataFrame([(i, float(v)) for i, v in enumerate(m)], "i INT, m DOUBLE")
    x = {k: rng.normal(size=n).astype(np.float32).tolist() for k, n in (("a", 40), ("b", 40), ("short", 11), ("long", 45), ("none", 0))}
    x["b"][4] = None
    rows = spark.createDataFrame([*x.items(), ("null", None)], "id STRING, embedding ARRAY<FLOAT>")
    monkeypatch.setattr(scoring, "BLOCK_CELLS", 300)
    monkeypatch.setattr(scoring, "PROJECTED_ROWS", 2)
    out = scoring.whiten_rows(rows, "id", pca, mean)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.o): r.y for r in out.collect()}
    centred = {k: np.array([0.0 if v is None else v - c for v, c in zip(values, m)] + [0.0] * (40 - len(values))) for k, values in x.items() if values}
    want = {(k, o): float(w[o] @ c) for k, c in centred.items() for o in range(50) if o != 7}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()))
    assert scoring.whiten_rows(rows, "id", pca.limit(0), mean).count() == 0


def test_large_projection(spark):
    """1,024 x 4,096 in four blocks of the usual size: y of a unit vector is a column of the matrix."""
    n, outputs = 4_096, 1_024
    cell = spark.range(outputs * n).select((F.col("id") / n).cast("int").alias("o"), (F.col("id") % n).cast("int").alias("i"))
    pca = cell.withColumn("w", (F.col("o") * 7 + F.col("i") % 13).cast("double"))
    mean = spark.range(n).select(F.col("id").cast("int").alias("i"), F.lit(0.0).alias("m"))
    unit = lambda k: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: (j == k).cast("float"))
    rows = spark.range(3).select("id", unit(F.col("id") * 1_000).alias("embedding"))
    got = scoring.whiten_rows(rows, "id", pca, mean)
    bad = got.where(F.col("y") != F.col("o") * 7 + (F.col("id") * 1_000) % 13)
    assert got.count() == 3 * outputs and bad.count() == 0


def test_large_dictionary(spark):
    """50,000 classes: ranked first, names joined, one row a clip, equal ones too."""
    n = 50_000
    classes = spark.range(n).select(F.col("id").cast("int").alias("class_id"), F.concat(F.lit("class "), "id").alias("display_name"))
    rng = np.random.default_rng(5)
    head = Dense(rng.normal(size=(n, 5)) * 3, np.zeros(n))
    weights = rng.normal(size=(5, 12))
    projection = Projection(rng.normal(size=(5, 5)), rng.normal(size=5))
    samples = [int(v) for v in rng.integers(-20_000, 20_000, 200)]
    clips = spark.createDataFrame([("a", 1, 8_000, samples), ("a", 1, 8_000, samples), ("b", 1, 8_000, [1, 2])], "clip STRING, n_channels INT, sample_rate INT, samples ARRAY<SMALLINT>")
    found = clips.transform(detect(Classifier(lambda: lambda x: x @ weights.T, projection, [head], classes), CFG)).collect()
    scores = reference_scores(samples, 1, lambda x: x @ weights.T, projection, head)
    want = [f"class {i}" for _, i in sorted((-s, i) for i, s in enumerate(scores) if s > 0.1)[:20]]
    assert sorted((r.clip, [p.label for p in r.predictions], r.flag) for r in found) == [("a", want, 0), ("a", want, 0), ("b", [], 0)]


@pytest.mark.parametrize(
    "labels,flag",
    [
        (["Gunshot, gunfire"], 1), (["Cap Gun"], 1), (["Speech", "Explosion"], 1), (["gunshot"], 0),
        (["Machine gun"], 0), (["Speech"], 0), ([], 0),
    ],
)
def test_alert_flag(spark, labels, flag):
    df = spark.createDataFrame([(labels,)], "labels ARRAY<STRING>")
    assert df.select(alert_flag(F.col("labels"), ("Gun", "Explosion"))).first()[0] == flag


def test_quantiser_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, -2.0, 0.0, 1.999, 2.0, 2.5)], "y DOUBLE")
    assert [r[0] for r in df.select(quantize(F.col("y"))).collect()] == [0, 0, 127, 254, 255, 255]


def test_two_decimals_is_exact(spark):
    values = [0.125, 0.375, 0.625, 0.875, 0.145, 0.155, 0.285, 0.995, 0.9999, 1.0, 0.0, 0.005, 0.015, 1e-9, 2.675, -0.125]
    values += [k / 1000 + 0.0005 * (k % 2) for k in range(0, 1000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = {r.v: r.t for r in df.select("v", two_decimals(F.col("v")).alias("t")).collect()}
    assert {v: t for v, t in got.items() if 0 <= v <= 1} == {v: f"{v:.2f}" for v in values if 0 <= v <= 1}


def test_texts(spark):
    df = spark.createDataFrame([([("Speech", 0.9475), ('Say "hi"', 0.25)],)], PREDICTIONS)
    formatted, payload = df.select(format_predictions(F.col("predictions")), predictions_json(F.col("predictions"))).first()
    assert formatted == 'Speech: 0.95, Say "hi": 0.25'
    assert json.loads(payload) == [["Speech", 0.9475], ['Say "hi"', 0.25]]
    assert df.select(notification(F.lit("as is"), True)).first()[0] == "as is"
    line = df.select(headline(F.lit(1), F.lit("s1"), F.lit("now")), headline(F.lit(0), F.lit("s1"), F.lit("now")))
    assert tuple(line.first()) == ("GUNSHOT DETECTED near s1 at now", "No threats near s1 at now")
    names = spark.range(1).select(record_name(F.lit(2.5)), record_name(F.lit(3.5)))
    assert tuple(names.first()) == ("record_2.wav", "record_4.wav")


def test_int16_check(spark):
    assert spark.range(1).select(checked_int16(F.lit(-32_768))).first()[0] == -32_768
    with pytest.raises(Exception, match="bad sample"):
        spark.range(1).select(checked_int16(F.lit(40_000))).collect()


def test_cross_entropy_is_stable(spark):
    df = spark.createDataFrame([(800.0, 0), (-800.0, 1), (0.0, 1)], "z DOUBLE, y INT")
    got = [r[0] for r in df.select(sigmoid_cross_entropy(F.col("z"), F.col("y"))).collect()]
    assert np.allclose(got, [800.0, 800.0, np.log(2)])


def test_embedding_statistics(spark):
    df = spark.createDataFrame([(48,), (198,)], "q INT")
    assert tuple(embedding_statistics(df, "q").first()) == (123.0, 75.0, 1)
    assert embedding_statistics(df, "q", mean=150.0).first().ok == 0


def test_projection_shapes(spark):
    pca = spark.createDataFrame([(o, i, float(o == i)) for o in range(3) for i in range(3)], "o INT, i INT, w DOUBLE")
    mean = spark.createDataFrame([(i, 1.0) for i in range(3)], "i INT, m DOUBLE")
    loaded = load_projection(pca, mean, 3)
    assert (loaded.matrix == np.eye(3)).all() and (loaded.mean == 1).all()
    for bad in (lambda: load_projection(pca, mean, 4), lambda: load_projection(pca.limit(8), mean, 3)):
        with pytest.raises(ValueError, match="bad matrix shape"):
            bad()
    with pytest.raises(ValueError, match="bad mean shape"):
        load_projection(pca, mean.limit(2), 3)
    rows = spark.createDataFrame([(1, [3.0, 4.0, 5.0]), (2, [1.0, 1.0, 1.0])], "id INT, embedding ARRAY<FLOAT>")
    array = {r.id: r.y for r in rows.select("id", scoring.whiten(F.col("embedding"), loaded).alias("y")).collect()}
    assert array == {1: [2.0, 3.0, 4.0], 2: [0.0, 0.0, 0.0]}
    joined = scoring.whiten_rows(rows, "id", pca, mean).collect()
    assert {(r.id, r.o): r.y for r in joined} == {(i, o): y for i, ys in array.items() for o, y in enumerate(ys)}


def test_two_layer_head(spark):
    hidden = Dense(np.array([[1.0, -1.0], [-1.0, 1.0], [0.5, 0.5]]), np.array([0.0, 0.1, -1.0]), "relu")
    out = Dense(np.array([[1.0, 2.0, 3.0], [0.0, -1.0, 1.0]]), np.zeros(2))
    df = spark.createDataFrame([([2.0, 1.0],), ([-1.0, 4.0],)], "x ARRAY<DOUBLE>")
    got = [r[0] for r in df.select(scoring.dense(F.col("x"), hidden, out)).collect()]
    x = np.array([[2.0, 1.0], [-1.0, 4.0]])
    z = np.maximum(x @ hidden.weights.T + hidden.bias, 0) @ out.weights.T
    assert np.allclose(got, 1 / (1 + np.exp(-z)))


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(dir=folder)
        return lambda x: x * 2.0

    rows = spark.range(64).repartition(32).select(F.array(F.array(F.col("id").cast("double"))).alias("p"))
    doubled = rows.select(scoring.embed_clips(F.col("p"), load, 1)[0][0].alias("y"))
    assert doubled.agg(F.sum("y")).first()[0] == 2.0 * sum(range(64))
    assert 1 <= len(list(tmp_path.iterdir())) <= 8


# --- whole clips -----------------------------------------------------------------------

CFG = DetectConfig(
    features=FeatureConfig(sample_rate=8_000, window=16, hop=8, bands=4, upper_hz=3_800.0, patch_frames=3, value_type="double"),
    max_frames=2,
)


def reference_scores(samples, channels, model, projection, head):
    """The same steps in plain numpy for one clip."""
    f = CFG.features
    x = np.array(samples, dtype=float).reshape(-1, channels).mean(axis=1) / 32_768.0
    count = 1 + (len(x) - f.window) // f.hop if len(x) >= f.window else 0
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(f.window) / f.window)
    mel = lambda hz: 1127.0 * np.log(1 + hz / 700.0)
    edges = np.linspace(mel(f.lower_hz), mel(f.upper_hz), f.bands + 2)
    at = mel(np.linspace(0, f.sample_rate / 2, f.bins))
    rows = []
    for n in range(count):
        mags = np.abs(np.fft.rfft(x[n * f.hop : n * f.hop + f.window] * hann, f.fft))
        rows.append([
            np.log(f.log_offset + sum(
                mags[b] * max(0.0, min((at[b] - lo) / (mid - lo), (hi - at[b]) / (hi - mid))) for b in range(1, f.bins)
            ))
            for lo, mid, hi in zip(edges, edges[1:], edges[2:])
        ])
    patches = [np.concatenate(rows[p * 3 : p * 3 + 3]) for p in range(count // 3)][:2]
    if not patches:
        return []
    whitened = [(projection.matrix @ (model(np.array([p]))[0] - projection.mean)) for p in patches]
    return head.apply(np.mean(whitened, axis=0))


def test_detect(spark):
    rng = np.random.default_rng(11)
    weights = rng.normal(size=(5, 12))
    projection = Projection(rng.normal(size=(5, 5)), rng.normal(size=5))
    head = Dense(rng.normal(size=(4, 5)) * 3, np.zeros(4))
    names = ["Gunshot, gunfire", "Speech", "Explosion", "Music"]
    classes = spark.createDataFrame(list(enumerate(names)), "class_id INT, display_name STRING")
    signals = {
        "mono": (1, rng.integers(-20_000, 20_000, 200)), "stereo": (2, rng.integers(-20_000, 20_000, 160)),
        "one_patch": (1, rng.integers(-200, 200, 40)), "short": (1, rng.integers(-9, 9, 7)),
    }
    rows = [(n, c, 8_000, [int(v) for v in x]) for n, (c, x) in signals.items()]
    clips = spark.createDataFrame(rows, "clip STRING, n_channels INT, sample_rate INT, samples ARRAY<SMALLINT>")
    classifier = Classifier(lambda: lambda x: x @ weights.T, projection, [head], classes)
    found = clips.transform(detect(classifier, CFG))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    for row in found.collect():
        channels, samples = signals[row.clip]
        scores = reference_scores(samples, channels, lambda x: x @ weights.T, projection, head)
        want = sorted([(-s, i) for i, s in enumerate(scores) if s > 0.1])
        assert [p.label for p in row.predictions] == [names[i] for _, i in want]
        assert np.allclose([p.score for p in row.predictions], [-s for s, _ in want])
        assert row.flag == int(any("Gun" in names[i] or "Explosion" in names[i] for _, i in want))
    with pytest.raises(TypeError, match="bad sample type"):
        clips.withColumn("samples", F.col("samples").cast("array<int>")).transform(detect(classifier, CFG))
