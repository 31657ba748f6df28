"""Queries on waveforms, frames, spectra and patches."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.config import PRESET_16000, PRESET_22050, FeatureConfig
from acoustic_spark.functions.spectral import hertz_to_mel, periodic_hann
from acoustic_spark.functions.waveform import channel_count, checked_int16, mono_array, normalise, sample_time
from acoustic_spark.operators import frames, spectrum
from acoustic_spark.operators.positions import with_position
from acoustic_spark.operators.resample import resample_array, resample_series
from acoustic_spark.plans.registry import query
from acoustic_spark.plans.tables import CLIP_SAMPLES, SERIES, SMALL, clip_rows, clips, read, series

W, HOP, FFT, BINS = SMALL.window, SMALL.hop, SMALL.fft, SMALL.bins
PATCH, BANDS = SMALL.patch_frames, SMALL.bands
KEY = ["sensor_id"]


def big(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


# SQL of the feature steps; each text continues the one before it.
FRAMES = f"""{SERIES}, frames AS (
  SELECT sensor_id, frame, i - frame * {HOP} AS k, x FROM (
    SELECT *, unnest(range(greatest(0, CAST(ceil((i - {W - 1}) / {HOP}.0) AS BIGINT)), i // {HOP} + 1)) AS frame FROM series)
  WHERE n >= {W} AND frame <= (n - {W}) // {HOP})"""

SPECTRUM = f"""{FRAMES}, basis AS (
  SELECT k, b, 0.5 - 0.5 * cos(2 * pi() * k / {W}) AS h, 2 * pi() * k * b / {FFT} AS angle
  FROM range({W}) AS ks(k), range({BINS}) AS bs(b)),
spectrum AS (
  SELECT sensor_id, frame, b, sqrt(pow(sum(x * h * cos(angle)), 2) + pow(sum(x * h * sin(angle)), 2)) AS mag
  FROM frames JOIN basis USING (k) GROUP BY ALL)"""


def mel_sql(cfg) -> str:
    """SQL of the mel weights."""
    return f"""mel_edges AS (
  SELECT b, band, 1127.0 * ln(1.0 + (b * {cfg.sample_rate / 2} / {cfg.bins - 1}) / 700.0) AS m,
         1127.0 * ln(1.0 + {cfg.lower_hz} / 700.0) AS low,
         (1127.0 * ln(1.0 + {cfg.upper_hz} / 700.0) - 1127.0 * ln(1.0 + {cfg.lower_hz} / 700.0)) / {cfg.bands + 1} AS step
  FROM range({cfg.bins}) AS bs(b), range({cfg.bands}) AS ms(band)),
mel AS (
  SELECT b, band, CASE WHEN b = 0 THEN 0 ELSE
    greatest(0, least((m - (low + band * step)) / step, (low + (band + 2) * step - m) / step)) END AS w FROM mel_edges)"""


LOG_MEL = f"""{SPECTRUM}, {mel_sql(SMALL)}, log_mel AS (
  SELECT sensor_id, frame, band, ln(sum(mag * w) + {SMALL.log_offset}) AS v FROM spectrum JOIN mel USING (b) GROUP BY ALL)"""

PATCHES = f"""{LOG_MEL}, patches AS (
  SELECT sensor_id, frame // {PATCH} AS example, frame % {PATCH} AS frame, band, v FROM log_mel
  QUALIFY count(*) OVER (PARTITION BY sensor_id, frame // {PATCH}) = {PATCH * BANDS})"""


# --- waveform ---------------------------------------------------------------------


@query(
    "channel_layout",
    f"""WITH {SERIES}, {clip_rows()}
SELECT sensor_id, CAST(clip_no AS BIGINT) AS clip_no, CAST(2 AS BIGINT) AS n_channels, CAST(pos // 2 AS BIGINT) AS frame,
       CAST(pos % 2 AS BIGINT) AS channel, s AS sample
FROM clip_rows WHERE n_samples = {CLIP_SAMPLES}""",
)
def channel_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Whole clips read as frames of two interleaved channels."""
    whole = clips(spark, sf).filter(F.col("n_samples") == CLIP_SAMPLES)
    channels = channel_count(F.col("n_samples"), CLIP_SAMPLES // 2)
    checked = F.transform("samples", lambda s: checked_int16(s.cast("int")))
    return whole.withColumn("n_channels", channels).select(
        "sensor_id", "clip_no", *big("n_channels"), F.posexplode(checked).alias("pos", "sample")
    ).select(
        "sensor_id",
        "clip_no",
        "n_channels",
        F.floor(F.col("pos") / F.col("n_channels")).alias("frame"),
        (F.col("pos") % F.col("n_channels")).alias("channel"),
        *big("sample"),
    )


@query("normalised_samples", "SELECT event_id, value / 32768.0::DOUBLE AS x FROM events")
def normalised_samples(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("event_id", normalise(F.col("value")).alias("x"))


MONO = f"""WITH {SERIES}
SELECT sensor_id, CAST(i // 2 AS BIGINT) AS frame, round(avg(x), 6) AS x FROM series
GROUP BY sensor_id, i // 2 HAVING count(*) = 2"""


@query("mono_mix", MONO)
def mono_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of two interleaved channels over the long table."""
    return (
        series(spark, sf)
        .groupBy("sensor_id", F.floor(F.col("i") / 2).alias("frame"))
        .agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("_channels"))
        .filter(F.col("_channels") == 2)
        .select("sensor_id", "frame", F.round("x", 6).alias("x"))
    )


@query(
    "mono_mix_clips",
    f"""WITH {SERIES}, {clip_rows()}
SELECT sensor_id, CAST(clip_no AS BIGINT) AS clip_no, CAST(pos // 2 AS BIGINT) AS frame, avg(s) AS x FROM clip_rows
GROUP BY sensor_id, clip_no, pos // 2 HAVING count(*) = 2""",
)
def mono_mix_clips(spark: SparkSession, sf: str) -> DataFrame:
    """The same on clip arrays, row by row."""
    mixed = clips(spark, sf).withColumn("x", mono_array(F.col("samples"), F.lit(2)))
    return mixed.select("sensor_id", "clip_no", F.posexplode("x").alias("frame", "x")).withColumn(
        "frame", F.col("frame").cast("bigint")
    )


@query(
    "sample_times",
    f"""WITH {SERIES}
SELECT sensor_id, CAST(i AS BIGINT) AS i, CASE WHEN n > 1 THEN round(i * (n // 8) / (n - 1)::DOUBLE, 6) ELSE 0.0::DOUBLE END AS t
FROM series""",
)
def sample_times(spark: SparkSession, sf: str) -> DataFrame:
    return series(spark, sf).select(
        "sensor_id", *big("i"), F.round(sample_time(F.col("i"), F.col("n"), 8), 6).alias("t")
    )


RESAMPLED = f"""WITH {SERIES}, spread AS (
  SELECT sensor_id, n * 3 // 4 AS n, x, i,
         unnest(range(greatest(0, CAST(floor((i - 1) * 3 / 4.0) AS BIGINT) + 1),
                      least(CAST(ceil((i + 1) * 3 / 4.0) AS BIGINT), n * 3 // 4))) AS j
  FROM series)
SELECT sensor_id, CAST(j AS BIGINT) AS i, CAST(n AS BIGINT) AS n, round(sum(x * (1 - abs(j * 4 / 3.0::DOUBLE - i))), 6) AS x
FROM spread GROUP BY sensor_id, j, n"""


@query("resampled_series", RESAMPLED)
def resampled_series(spark: SparkSession, sf: str) -> DataFrame:
    """Linear resampling from 16 to 12 kHz over the long table."""
    return resample_series(series(spark, sf), KEY, 16_000, 12_000).select(
        "sensor_id", "i", *big("n"), F.round("x", 6).alias("x")
    )


# 16 to 12 kHz: three outputs for four samples, 22 taps a side, weights by distance in thirds of a sample.
SINC = f"""WITH {SERIES}, taps AS (
  SELECT d, d / 3.0::DOUBLE AS away, 8.6 * sqrt(greatest(0, 1 - pow(d / 66.0::DOUBLE, 2))) AS u FROM range(-66, 66) r(d)),
weights AS MATERIALIZED (
  SELECT d, 0.75 * CASE WHEN d = 0 THEN 1 ELSE sin(pi() * 0.75 * away) / (pi() * 0.75 * away) END
    * list_sum(list_transform(range(0, 45), lambda k: pow(u * u / 4, k) / pow(gamma(k + 1), 2)))
    / list_sum(list_transform(range(0, 45), lambda k: pow(8.6 * 8.6 / 4, k) / pow(gamma(k + 1), 2))) AS w FROM taps),
spread AS (
  SELECT sensor_id, i, x, n * 3 // 4 AS m, unnest(range(greatest(0, CAST(floor((i - 22) * 3 / 4.0) AS BIGINT) - 1), least(CAST(ceil((i + 22) * 3 / 4.0) AS BIGINT) + 1, n * 3 // 4))) AS j FROM series)
SELECT sensor_id, CAST(j AS BIGINT) AS i, CAST(m AS BIGINT) AS n, round(sum(x * w), 6) AS x
FROM spread JOIN weights ON d = j * 4 - i * 3 GROUP BY sensor_id, j, m"""


@query("resampled_series_sinc", SINC)
def resampled_series_sinc(spark: SparkSession, sf: str) -> DataFrame:
    """Windowed-sinc resampling from 16 to 12 kHz over the long table."""
    return resample_series(series(spark, sf), KEY, 16_000, 12_000, "sinc").select("sensor_id", "i", *big("n"), F.round("x", 6).alias("x"))


@query(
    "resampled_clips",
    f"""WITH {SERIES}, {clip_rows()}, spread AS (
  SELECT sensor_id, clip_no, s, pos,
         unnest(range(greatest(0, CAST(floor((pos - 1) * 3 / 4.0) AS BIGINT) + 1),
                      least(CAST(ceil((pos + 1) * 3 / 4.0) AS BIGINT), n_samples * 3 // 4))) AS j
  FROM clip_rows)
SELECT sensor_id, CAST(clip_no AS BIGINT) AS clip_no, CAST(j AS BIGINT) AS i,
       round(sum(s * (1 - abs(j * 4 / 3.0::DOUBLE - pos))), 6) AS x
FROM spread GROUP BY sensor_id, clip_no, j""",
)
def resampled_clips(spark: SparkSession, sf: str) -> DataFrame:
    """Linear resampling of clip arrays."""
    target = SMALL.sample_rate * 3 // 4
    out = clips(spark, sf).withColumn("x", resample_array(F.col("samples"), F.col("sample_rate"), target, "linear"))
    return out.select("sensor_id", "clip_no", F.posexplode("x").alias("i", "x")).select(
        "sensor_id", "clip_no", *big("i"), F.round("x", 6).alias("x")
    )


# --- frames and spectra -----------------------------------------------------------------


@query("frames", f"WITH {FRAMES} SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(k AS BIGINT) AS k, x FROM frames")
def frame_table(spark: SparkSession, sf: str) -> DataFrame:
    return frames.frame_rows(series(spark, sf), KEY, W, HOP).select("sensor_id", *big("frame", "k"), "x")


@query(
    "clip_frames",
    f"""WITH {SERIES}, {clip_rows()}
SELECT sensor_id, CAST(clip_no AS BIGINT) AS clip_no, CAST(frame AS BIGINT) AS frame, CAST(pos - frame * 4 AS BIGINT) AS k, s AS sample
FROM clip_rows, range({CLIP_SAMPLES}) AS f(frame)
WHERE pos BETWEEN frame * 4 AND frame * 4 + 7 AND frame * 4 + 8 <= n_samples""",
)
def clip_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping windows of clip arrays, row by row."""
    cut = frames.frame_arrays(clips(spark, sf), "samples", 8, 4)
    return cut.select(
        "sensor_id", "clip_no", *big("frame"), F.posexplode("samples").alias("k", "sample")
    ).select("sensor_id", "clip_no", "frame", *big("k", "sample"))


@query(
    "windowed_frames",
    f"""WITH {FRAMES} SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(k AS BIGINT) AS k,
  round(x * (0.5 - 0.5 * cos(2 * pi() * k / {W})), 6) AS x FROM frames""",
)
def windowed_frames(spark: SparkSession, sf: str) -> DataFrame:
    weighted = F.col("x") * periodic_hann(F.col("k"), W)
    return frames.frame_rows(series(spark, sf), KEY, W, HOP).select(
        "sensor_id", *big("frame", "k"), F.round(weighted, 6).alias("x")
    )


MAGNITUDES = f"""WITH {SPECTRUM}
SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(b AS BIGINT) AS b, round(mag, 6) AS mag FROM spectrum"""


def _magnitudes(rows: DataFrame) -> DataFrame:
    return rows.select("sensor_id", *big("frame", "b"), F.round("mag", 6).alias("mag"))


@query("magnitude_spectrum", MAGNITUDES)
def magnitude_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    return _magnitudes(spectrum.spectrum_rows(series(spark, sf), KEY, W, HOP, FFT))


@query("magnitude_spectrum_arrow", MAGNITUDES)
def magnitude_spectrum_arrow(spark: SparkSession, sf: str) -> DataFrame:
    """The same from one array for each frame."""
    rows = frames.frame_rows(series(spark, sf), KEY, W, HOP).groupBy(*KEY, "frame").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("_rows"))
    mags = rows.select(*KEY, "frame", spectrum.magnitudes(F.col("_rows.x"), W, W, FFT)[0].alias("_mags"))
    return _magnitudes(mags.select(*KEY, "frame", F.posexplode("_mags").alias("b", "mag")))


@query("mel_scale", "SELECT event_id, round(1127.0 * ln(1.0 + value * 100 / 700.0), 6) AS mel FROM events")
def mel_scale(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("event_id", F.round(hertz_to_mel(F.col("value") * 100), 6).alias("mel"))


@query(
    "mel_weighted_spectrum",
    f"""WITH {SPECTRUM}, {mel_sql(SMALL)}
SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(b AS BIGINT) AS b, CAST(band AS BIGINT) AS band,
       round(w, 6) AS w, round(mag * w, 6) AS energy
FROM spectrum JOIN mel USING (b) WHERE w > 0 OR b = 0""",
)
def mel_weighted_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    """Filter-bank weights applied to every bin of the spectrum."""
    rows = spectrum.spectrum_rows(series(spark, sf), KEY, W, HOP, FFT)
    weighted = rows.join(F.broadcast(spectrum.mel_table(spark, SMALL)), "b")
    return weighted.select(
        "sensor_id",
        *big("frame", "b", "band"),
        F.round("w", 6).alias("w"),
        F.round(F.col("mag") * F.col("w"), 6).alias("energy"),
    )


@query(
    "log_mel",
    f"""WITH {LOG_MEL}
SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(band AS BIGINT) AS band, round(v, 6) AS v FROM log_mel""",
)
def log_mel(spark: SparkSession, sf: str) -> DataFrame:
    return spectrum.series_log_mel(series(spark, sf), KEY, SMALL).select(
        "sensor_id", *big("frame", "band"), F.round("v", 6).alias("v")
    )


PATCH_ROWS = f"""WITH {PATCHES}
SELECT sensor_id, CAST(example AS BIGINT) AS example, CAST(frame AS BIGINT) AS frame, CAST(band AS BIGINT) AS band,
       round(v, 6) AS v FROM patches"""


def _patch_rows(patches: DataFrame) -> DataFrame:
    return spectrum.feature_rows(patches, KEY, BANDS).select(
        "sensor_id", *big("example", "frame", "band"), F.round("v", 6).alias("v")
    )


@query("patches", PATCH_ROWS)
def patch_table(spark: SparkSession, sf: str) -> DataFrame:
    return _patch_rows(spectrum.series_patches(series(spark, sf), KEY, SMALL))


def arrow_patches(spark: SparkSession, sf: str) -> DataFrame:
    """Patches of each sensor's series from the Arrow form: (sensor_id, example, patch)."""
    cut = frames.patch_clips(series(spark, sf), KEY, SMALL)
    return cut.select("sensor_id", "example", spectrum.patches(F.col("samples"), SMALL)[0].alias("patch"))


@query("patches_arrow", PATCH_ROWS)
def patch_table_arrow(spark: SparkSession, sf: str) -> DataFrame:
    return _patch_rows(arrow_patches(spark, sf))


# --- the same at the real settings ------------------------------------------------
# `embeddings` stands for recordings, one for ten labels: the values of its vectors, in the
# order of the vectors, are the samples.


def recording(spark: SparkSession, sf: str) -> DataFrame:
    label = F.floor(F.col("label") / 10).alias("sensor_id")
    values = read(spark, sf, "embeddings").select(label, "vec_id", F.posexplode("embedding").alias("pos", "x"))
    return with_position(values.select("sensor_id", (F.col("vec_id") * 64 + F.col("pos")).alias("seq"), F.col("x").cast("double").alias("x")), KEY, "seq")


def preset_sql(cfg: FeatureConfig) -> str:
    """SQL of the log-mel table at a preset; the transform is a sum over the window for each frame and bin."""
    return f"""WITH series AS (
  SELECT sensor_id, x, row_number() OVER (PARTITION BY sensor_id ORDER BY seq) - 1 AS i, count(*) OVER (PARTITION BY sensor_id) AS n FROM (
    SELECT CAST(label // 10 AS BIGINT) AS sensor_id, vec_id * 64 + unnest(range(len(embedding))) AS seq, unnest(embedding)::DOUBLE AS x FROM embeddings)),
frames AS (
  SELECT sensor_id, frame, i - frame * {cfg.hop} AS k, x FROM (
    SELECT *, unnest(range(greatest(0, CAST(ceil((i - {cfg.window - 1}) / {cfg.hop}.0) AS BIGINT)), i // {cfg.hop} + 1)) AS frame FROM series)
  WHERE n >= {cfg.window} AND frame <= (n - {cfg.window}) // {cfg.hop}),
basis AS (
  SELECT k, b, h * cos(angle) AS c, h * sin(angle) AS s FROM (
    SELECT k, b, 0.5 - 0.5 * cos(2 * pi() * k / {cfg.window}) AS h, 2 * pi() * ((k * b) % {cfg.fft}) / {cfg.fft} AS angle
    FROM range({cfg.window}) AS ks(k), range({cfg.bins}) AS bs(b))),
spectrum AS (
  SELECT sensor_id, frame, b, sqrt(pow(sum(x * c), 2) + pow(sum(x * s), 2)) AS mag FROM frames JOIN basis USING (k) GROUP BY ALL),
{mel_sql(cfg)},
log_mel AS (
  SELECT sensor_id, frame, band, ln(sum(mag * w) + {cfg.log_offset}) AS v FROM spectrum JOIN mel USING (b) GROUP BY ALL)"""


def preset_patches_sql(cfg: FeatureConfig) -> str:
    return f"""{preset_sql(cfg)}
SELECT sensor_id, CAST(frame // {cfg.patch_frames} AS BIGINT) AS example, CAST(frame % {cfg.patch_frames} AS BIGINT) AS frame,
       CAST(band AS BIGINT) AS band, round(v, 6) AS v
FROM log_mel QUALIFY count(*) OVER (PARTITION BY sensor_id, frame // {cfg.patch_frames}) = {cfg.patch_frames * cfg.bands}"""


def preset_patches(spark: SparkSession, sf: str, cfg: FeatureConfig) -> DataFrame:
    cut = spectrum.series_patches(recording(spark, sf), KEY, replace(cfg, value_type="double"))
    return spectrum.feature_rows(cut, KEY, cfg.bands).select("sensor_id", *big("example", "frame", "band"), F.round("v", 6).alias("v"))


@query(
    "log_mel_22050",
    f"""{preset_sql(PRESET_22050)}
SELECT sensor_id, CAST(frame AS BIGINT) AS frame, CAST(band AS BIGINT) AS band, round(v, 6) AS v FROM log_mel""",
)
def log_mel_22050(spark: SparkSession, sf: str) -> DataFrame:
    rows = spectrum.series_log_mel(recording(spark, sf), KEY, PRESET_22050)
    return rows.select("sensor_id", *big("frame", "band"), F.round("v", 6).alias("v"))


@query("patches_22050", preset_patches_sql(PRESET_22050))
def patches_22050(spark: SparkSession, sf: str) -> DataFrame:
    return preset_patches(spark, sf, PRESET_22050)


@query("patches_16000", preset_patches_sql(PRESET_16000))
def patches_16000(spark: SparkSession, sf: str) -> DataFrame:
    return preset_patches(spark, sf, PRESET_16000)


RESIZE = 60


@query(
    "resized_series",
    f"""WITH {SERIES}
SELECT s.sensor_id, CAST(p AS BIGINT) AS i, CAST(least(s.n, {RESIZE}) AS BIGINT) AS n_valid, coalesce(x, 0) AS x
FROM (SELECT DISTINCT sensor_id, n FROM series) s CROSS JOIN range({RESIZE}) AS r(p)
LEFT JOIN series t ON t.sensor_id = s.sensor_id AND t.i = p""",
)
def resized_series(spark: SparkSession, sf: str) -> DataFrame:
    """Every sensor's series cut or padded to the same length."""
    return frames.resize_rows(series(spark, sf), KEY, "i", "x", RESIZE).select("sensor_id", *big("i", "n_valid"), "x")


@query(
    "resized_arrays",
    """SELECT vec_id, CAST(p AS BIGINT) AS pos, CAST(least(len(embedding), size) AS BIGINT) AS n_valid,
       CAST(size AS BIGINT) AS size, CASE WHEN p < len(embedding) THEN CAST(embedding[p + 1] AS DOUBLE) ELSE 0 END AS x
FROM embeddings, (VALUES (48), (100)) AS sizes(size), range(100) AS r(p) WHERE p < size""",
)
def resized_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding arrays cut to 48 and padded to 100 values."""
    rows = read(spark, sf, "embeddings")

    def resized(size: int) -> DataFrame:
        return rows.select(
            "vec_id",
            F.lit(size).cast("bigint").alias("size"),
            frames.valid_count(F.size("embedding"), size).cast("bigint").alias("n_valid"),
            F.posexplode(frames.resize_array(F.col("embedding"), size)).alias("pos", "x"),
        ).withColumn("pos", F.col("pos").cast("bigint"))

    return resized(48).unionByName(resized(100))
