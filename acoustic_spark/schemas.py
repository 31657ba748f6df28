"""Table schemas."""

from pyspark.sql import types as T

PREDICTION = T.StructType(
    [T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())]
)
PREDICTIONS = T.ArrayType(PREDICTION)

MESSAGES = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("offset", T.LongType()),
    ]
)

CLIPS = T.StructType(
    [
        T.StructField("clip_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("n_channels", T.IntegerType()),
        T.StructField("n_samples", T.IntegerType()),
        T.StructField("samples", T.ArrayType(T.ShortType())),
    ]
)

CLASSES = T.StructType(
    [
        T.StructField("class_id", T.IntegerType()),
        T.StructField("mid", T.StringType()),
        T.StructField("display_name", T.StringType()),
    ]
)

DETECTIONS = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("flag", T.IntegerType()),
        T.StructField("predictions", PREDICTIONS),
        T.StructField("path", T.StringType()),
        T.StructField("ingest_seq", T.LongType()),
    ]
)

CLIP_META = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("start_s", T.DoubleType()),
        T.StructField("end_s", T.DoubleType()),
        T.StructField("labels", T.StringType()),
    ]
)

PROJECTION = T.StructType(
    [
        T.StructField("o", T.IntegerType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("w", T.DoubleType()),
    ]
)
PROJECTION_MEAN = T.StructType(
    [T.StructField("i", T.IntegerType()), T.StructField("m", T.DoubleType())]
)

METRICS = T.StructType(
    [
        T.StructField("epoch", T.IntegerType()),
        T.StructField("step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
    ]
)
