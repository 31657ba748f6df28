"""Frames, spectra, patches and resampling on signals with known answers."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acoustic_spark.config import PRESET_16000, PRESET_22050, FeatureConfig
from acoustic_spark.functions.waveform import frame_count, mono_array, sample_time
from acoustic_spark.operators import frames, spectrum
from acoustic_spark.operators.capture import capture_rows
from acoustic_spark.operators.positions import with_position
from acoustic_spark.operators.resample import mono_signal, resample_array, resample_series

RATE = 22_050


def clips(spark, **signals):
    rows = [(name, [float(v) for v in x]) for name, x in signals.items()]
    return spark.createDataFrame(rows, "name STRING, samples ARRAY<DOUBLE>")


def series(spark, **signals):
    rows = [(name, i, float(v)) for name, x in signals.items() for i, v in enumerate(x)]
    return with_position(spark.createDataFrame(rows, "name STRING, seq BIGINT, x DOUBLE"), ["name"], "seq", slice_rows=100)


def test_presets():
    assert (PRESET_22050.fft, PRESET_22050.bins, PRESET_16000.fft) == (1024, 513, 512)
    for bad in ({"lower_hz": -1.0}, {"lower_hz": 8_000.0}, {"upper_hz": 12_000.0}, {"window": 0}):
        with pytest.raises(ValueError):
            FeatureConfig(**bad)


def test_sine_patches_and_peak(spark):
    sine = np.round(20_000 * np.sin(2 * np.pi * 1_000 * np.arange(10 * RATE) / RATE))
    table = spark.createDataFrame([("sine", [int(v) for v in sine])], "name STRING, samples ARRAY<SMALLINT>")
    cut = spectrum.clip_patches(table, "samples", PRESET_22050, scale=32_768.0).select("example", F.size("patch").alias("n"))
    assert [tuple(r) for r in cut.orderBy("example").collect()] == [(e, 96 * 64) for e in range(10)]
    mags = table.select(spectrum.magnitudes(F.col("samples"), 551, 221, 1024).alias("m"))
    found = mags.select(F.size("m"), F.size(F.col("m")[0]), F.array_position(F.col("m")[5], F.array_max(F.col("m")[5])) - 1)
    assert tuple(found.first()) == (996, 513, 46)


def test_constant_impulse_short_exact(spark):
    impulse = np.zeros(64)
    impulse[20] = 1.0
    table = clips(spark, constant=np.ones(64), impulse=impulse, short=np.ones(31), exact=np.ones(32))
    mags = {r.name: np.array(r.m) for r in table.select("name", spectrum.magnitudes(F.col("samples"), 32, 16, 32).alias("m")).collect()}
    assert [len(mags[n]) for n in ("constant", "impulse", "short", "exact")] == [3, 3, 0, 1]
    assert (mags["constant"].argmax(axis=1) == 0).all()
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * 20 / 32)
    assert np.allclose(mags["impulse"][0], hann)


@pytest.mark.parametrize("n,expected", [(0, 0), (31, 0), (32, 1), (47, 1), (48, 2), (1_000, 61)])
def test_frame_count(spark, n, expected):
    assert spark.range(1).select(frame_count(F.lit(n), 32, 16)).first()[0] == expected


@pytest.mark.parametrize("window,hop", [(16, 8), (10, 3), (4, 9)])
def test_frames_match_brute_force(spark, window, hop):
    x = np.arange(61) ** 1.5
    want = {(f, k, x[f * hop + k]) for f in range(1 + (61 - window) // hop) for k in range(window)}
    long = frames.frame_rows(series(spark, a=x, tiny=x[:2]), ["name"], window, hop)
    assert {(r.frame, r.k, r.x) for r in long.collect()} == want
    array = frames.frame_arrays(clips(spark, a=x, tiny=x[:2]), "samples", window, hop)
    assert {(r.frame, k, v) for r in array.collect() for k, v in enumerate(r.samples)} == want


def test_series_equal_clips(spark, monkeypatch):
    monkeypatch.setattr(spectrum, "BLOCK_WINDOWS", 5)
    cfg = FeatureConfig(sample_rate=8_000, window=20, hop=7, bands=6, upper_hz=3_900.0, patch_frames=4, value_type="double")
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=150), "b": rng.normal(size=87), "c": rng.normal(size=40), "short": rng.normal(size=19)}
    long = {(r.name, r.example): r.patch for r in spectrum.series_patches(series(spark, **data), ["name"], cfg).collect()}
    table = clips(spark, **data)
    whole = {(r.name, i): p for r in table.select("name", spectrum.patches(F.col("samples"), cfg).alias("p")).collect() for i, p in enumerate(r.p)}
    rows = {(r.name, r.example): r.patch for r in spectrum.clip_patches(table, "samples", cfg).collect()}
    assert long.keys() == whole.keys() == rows.keys() and len(long) == 4 + 2
    mel = spectrum._mel_matrix(cfg)
    for name, x in data.items():
        n = max(0, (len(x) - 20) // 7 + 1)
        mags = np.array([np.abs(np.fft.rfft(x[i * 7 : i * 7 + 20] * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(20) / 20)), 32)) for i in range(n)]).reshape(n, 17)
        want = np.log(mags @ mel + cfg.log_offset)
        for e in range(n // 4):
            for found in (long, whole, rows):
                assert np.allclose(found[name, e], want[e * 4 : e * 4 + 4].ravel(), atol=1e-9)
        found = {(r.frame, r.b): r.mag for r in spectrum.spectrum_rows(series(spark, **{name: x}), ["name"], 20, 7, 32, size=3).collect()}
        assert len(found) == n * 17 and all(np.isclose(v, mags[k]) for k, v in found.items())


def test_an_hour_in_bounded_memory():
    samples = 3600 * PRESET_22050.sample_rate
    x = (np.arange(samples, dtype=np.int32) * 37 % 20_000 - 10_000).astype(np.int16)
    batch = pa.RecordBatch.from_arrays([pa.array(["a"]), pa.ListArray.from_arrays(pa.array([0, samples], pa.int32()), pa.array(x))], names=["name", "samples"])
    tracemalloc.start()
    n, most = 0, 0
    for out in spectrum.patch_batches(iter([batch]), "samples", PRESET_22050, scale=32_768.0):
        n += out.num_rows
        most = max(most, out.nbytes)
        assert out["example"][0].as_py() % spectrum.BLOCK_PATCHES == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == ((samples - PRESET_22050.window) // PRESET_22050.hop + 1) // 96
    assert peak < 64 << 20 and most < 4 << 20  # a block of windows, its transform and the patches of one batch


def test_feature_step_shuffles_the_samples_once(spark):
    cfg = FeatureConfig(sample_rate=8_000, window=16, hop=8, bands=4, upper_hz=3_900.0, patch_frames=3)
    rows = spark.range(400).select((F.col("id") % 2).alias("name"), F.col("id").alias("i"), F.lit(200).alias("n"), F.lit(1.0).alias("x"))
    plan = spectrum.series_patches(rows, ["name"], cfg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_mel_weights(spark):
    table = spectrum.mel_table(spark, PRESET_22050).collect()
    assert {r.band for r in table if r.b == 0} == set(range(64))
    assert all(r.w == 0 for r in table if r.b == 0) and all(0 < r.w <= 1 for r in table if r.b > 0)
    per_bin = {}
    for r in table:
        if r.b:
            per_bin.setdefault(r.b, []).append(r.w)
    assert max(map(len, per_bin.values())) == 2
    dense = spectrum._mel_matrix(PRESET_22050)
    assert all(math.isclose(dense[r.b, r.band], r.w, abs_tol=1e-9) for r in table)
    assert (dense > 0).sum() == sum(r.b > 0 for r in table)


def test_mono_and_time_axis(spark):
    stereo = clips(spark, a=[1, 3, -4, 8, 10])
    assert stereo.select(mono_array(F.col("samples"), F.lit(2))).first()[0] == [2.0, 2.0]
    assert stereo.select(mono_array(F.col("samples"), F.lit(9))).first()[0] is None
    fused = stereo.select(mono_signal(F.col("samples"), F.lit(2), F.lit(RATE), RATE)).first()[0]
    assert fused == [2.0, 2.0]
    axis = spark.range(5).select(sample_time(F.col("id"), F.lit(5), 2)).collect()
    assert [r[0] for r in axis] == [0.0, 0.5, 1.0, 1.5, 2.0]


def test_resize(spark):
    table = clips(spark, a=[1, 2, 3])
    assert table.select(frames.resize_array(F.col("samples"), 5)).first()[0] == [1, 2, 3, 0, 0]
    assert table.select(frames.resize_array(F.col("samples"), 2)).first()[0] == [1, 2]


def test_resample(spark):
    t = np.arange(4_000) / 16_000
    table = clips(spark, a=np.sin(2 * np.pi * 440 * t))
    out = np.array(table.select(resample_array(F.col("samples"), F.lit(16_000), 12_000)).first()[0])
    want = np.sin(2 * np.pi * 440 * np.arange(3_000) / 12_000)
    assert len(out) == 3_000 and np.abs(out - want)[50:-50].max() < 2e-3
    same = table.select(resample_array(F.col("samples"), F.lit(16_000), 16_000)).first()[0]
    assert same == table.first().samples
    with pytest.raises(ValueError):
        resample_array(F.col("samples"), F.lit(1), 1, "cubic")


@pytest.mark.parametrize("source,target", [(4, 3), (3, 4), (1, 2), (5, 5)])
def test_resample_long_form(spark, source, target):
    x = np.arange(40) ** 1.3
    long = {r.i: r.x for r in resample_series(series(spark, a=x), ["name"], source, target).collect()}
    array = clips(spark, a=x).select(resample_array(F.col("samples"), F.lit(source), target, "linear")).first()[0]
    assert sorted(long) == list(range(len(array)))
    assert np.allclose([long[i] for i in range(len(array))], array)


@pytest.mark.parametrize("source,target", [(4, 3), (3, 4), (22_050, 16_000), (5, 5)])
def test_sinc_of_a_series_is_that_of_an_array(spark, source, target):
    x = np.sin(np.arange(200) ** 1.3)
    long = {r.i: r.x for r in resample_series(series(spark, a=x), ["name"], source, target, "sinc").collect()}
    array = clips(spark, a=x).select(resample_array(F.col("samples"), F.lit(source), target)).first()[0]
    assert sorted(long) == list(range(len(array)))
    assert np.allclose([long[i] for i in range(len(array))], array, atol=1e-11)
    with pytest.raises(ValueError, match="unknown kernel"):
        resample_series(series(spark, a=x), ["name"], 4, 3, "cubic")


def test_capture_twin(spark):
    data = series(spark, a=np.arange(33), b=np.arange(9))
    got = capture_rows(data, ["name"], chunk=2, min_chunks=5, max_chunks=7).groupBy("name", "buffer").count().collect()
    assert sorted(map(tuple, got)) == [("a", 0, 10), ("a", 1, 10), ("a", 2, 10)]
    with pytest.raises(ValueError):
        capture_rows(data, ["name"], 1, 8, 7)
