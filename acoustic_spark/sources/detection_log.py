"""The detection log: pipe-separated text, its older comma form, and the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acoustic_spark.functions.text import clip_path, log_time, parse_predictions, print_predictions, strip_line_end

_ROW = "sensor_id STRING, dt STRING, flag STRING, list STRING, path STRING, extra STRING"


def _fields(line: Column, sep: str) -> Column:
    """Fields of one line; `extra` is set when the line has more than five."""
    return F.from_csv(line, _ROW, {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})


def _complete(row: Column) -> Column:
    named = row["sensor_id"].isNotNull() & row["dt"].isNotNull() & row["list"].isNotNull()
    return row["extra"].isNull() & row["flag"].isin("0", "1") & named


def _typed(row: Column) -> Column:
    return F.struct(
        row["sensor_id"].alias("sensor_id"),
        F.replace(row["dt"], F.lit("_"), F.lit(" ")).try_cast("timestamp_ntz").alias("ts"),
        row["flag"].cast("int").alias("flag"),
        parse_predictions(row["list"]).alias("predictions"),
        F.when(F.length(row["path"]) > 0, row["path"]).alias("path"),
    )


def parse_log(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Detections of log lines in either dialect, and the lines that are neither.

    An empty path becomes NULL; blank lines and banners go to the rejects. The
    line is parsed inside array functions, so that no filter on the result makes
    the planner parse it again.
    """
    rest = [c for c in lines.columns if c != line]
    text = strip_line_end(F.col(line))
    dialects = F.filter(F.array(_fields(text, "|"), _fields(text, ",")), _complete)
    parsed = F.filter(F.transform(dialects, _typed), lambda r: r["ts"].isNotNull() & r["predictions"].isNotNull())
    found = F.slice(parsed, 1, 1)
    rejects = lines.filter(F.size(found) == 0).select(*rest, text.alias("_corrupt"))
    return lines.select(*rest, F.inline(found)), rejects


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Detections of log files, and the rejected lines."""
    return parse_log(spark.read.text(path))


def log_line(sensor: Column, ts: Column, flag: Column, predictions: Column, path: Column) -> Column:
    """One line of the log; a label with an apostrophe makes the field quoted, with doubled quotes."""
    printed = print_predictions(predictions)
    quoted = F.concat(F.lit('"'), F.replace(printed, F.lit('"'), F.lit('""')), F.lit('"'))
    needs_quotes = F.contains(printed, F.lit('"')) | F.contains(printed, F.lit("|"))
    field = F.when(needs_quotes, quoted).otherwise(printed)
    return F.concat_ws("|", sensor, log_time(ts), flag.cast("string"), field, F.coalesce(path, F.lit("")))


def log_lines(detections: DataFrame) -> DataFrame:
    return detections.select(
        log_line(F.col("sensor_id"), F.col("ts"), F.col("flag"), F.col("predictions"), F.col("path")).alias("value")
    )


def write_log_text(detections: DataFrame, path: str) -> None:
    """Append the text form of the log, with CRLF line ends."""
    log_lines(detections).write.mode("append").option("lineSep", "\r\n").text(path)


def detection_rows(classified: DataFrame, folder: str, ts: str = "timestamp", seq: str = "offset") -> DataFrame:
    """Classified clips in the columns of the log: sensor, time and sequence number name its archive path."""
    at = F.col(ts).cast("timestamp_ntz")
    return classified.select(
        F.col("sensor_id").cast("string").alias("sensor_id"),
        at.alias("ts"),
        F.col("flag"),
        F.col("predictions"),
        clip_path(folder, F.col("sensor_id"), at, F.col(seq)).alias("path"),
        F.col(seq).cast("bigint").alias("ingest_seq"),
    )


def append_log(detections: DataFrame, path: str) -> None:
    """Append detections to the log table."""
    detections.write.mode("append").parquet(path)
