"""Text forms of times, paths and prediction lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# One item of a printed prediction list: a quoted label and a number. A label that
# holds an apostrophe is printed in double quotes.
_SINGLE = r"'((?:[^'\\]|\\.)*)'"
_DOUBLE = r'"((?:[^"\\]|\\.)*)"'
_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_ITEM = rf"\((?:{_SINGLE}|{_DOUBLE}),\s*({_NUMBER})\)"
_LIST = rf"^\[(?:{_ITEM}(?:,\s*{_ITEM})*)?\]$"


def view_time(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, cut from the printed time so that no time zone comes into play."""
    return F.substring(ts.cast("string"), 1, 19)


def log_time(ts: Column) -> Column:
    """`yyyy-MM-dd_HH:mm:ss`."""
    return F.replace(view_time(ts), F.lit(" "), F.lit("_"))


def archive_path(folder: Column, ts: Column) -> Column:
    return F.concat(folder, log_time(ts), F.lit(".wav"))


def clip_path(folder: str, sensor: Column, ts: Column, seq: Column) -> Column:
    """Path that names one clip in archive and log; the sequence number keeps clips of one second apart."""
    return F.concat(F.lit(f"{folder.rstrip('/')}/"), sensor.cast("string"), F.lit("/"), log_time(ts), F.lit("_"), seq.cast("string"), F.lit(".wav"))


def record_name(epoch_seconds: Column) -> Column:
    """File name from the rounded epoch; halves go to the even second."""
    return F.concat(F.lit("record_"), F.bround(epoch_seconds).cast("bigint"), F.lit(".wav"))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of the printed time, read as UTC: the session's time zone does not matter."""
    printed = F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z"))
    return F.unix_micros(printed.cast("timestamp")) / F.lit(1e6)


def two_decimals(score: Column) -> Column:
    """Text of a score with two decimals, rounded on its exact binary value, halves to even.

    `format_string` rounds the printed digits instead (0.145 and 0.125 differ).
    The whole part is taken off first, which is exact; in units of 2^-56 the hundredfold of
    the rest fits a BIGINT. Numbers from 2^53 on have no fraction.
    """
    unit = 56
    size = F.abs(score)
    fractional = size < F.lit(float(1 << 53))
    whole = F.when(fractional, F.floor(size)).cast("bigint")
    scaled = (size - whole) * F.lit(float(1 << unit))
    below = F.floor(scaled).cast("bigint")
    rest = (scaled - below) * 100
    # Anything below one unit counts as one, so that it still breaks a tie.
    hundredfold = below * 100 + F.ceil(rest).cast("bigint")
    # Half to even: add just under a half, and one more when the cents are odd.
    odd = F.shiftright(hundredfold, unit).bitwiseAND(F.lit(1))
    cents = F.shiftright(hundredfold + F.lit((1 << (unit - 1)) - 1) + odd, unit)
    total = whole.cast("decimal(16,0)") + cents.cast("decimal(4,0)") / F.lit(100).cast("decimal(3,0)")
    sign = F.when(score < 0, F.lit("-")).otherwise(F.lit(""))
    exact = F.concat(sign, total.cast("decimal(18,2)").cast("string"))
    return F.when(fractional, exact).otherwise(F.format_string("%.2f", score))


def format_predictions(predictions: Column) -> Column:
    """`label: 0.00, label: 0.00`."""
    return F.array_join(
        F.transform(predictions, lambda p: F.concat(p["label"], F.lit(": "), two_decimals(p["score"]))), ", "
    )


def headline(flag: Column, sensor: Column, at: Column) -> Column:
    return F.when(
        flag == 1, F.concat(F.lit("GUNSHOT DETECTED near "), sensor, F.lit(" at "), at)
    ).otherwise(F.concat(F.lit("No threats near "), sensor, F.lit(" at "), at))


def headline_colour(flag: Column) -> Column:
    return F.when(flag == 1, F.lit("r")).otherwise(F.lit("b"))


def sound_class_title(printed: Column) -> Column:
    """Title above the waveform, from the printed prediction list."""
    return F.concat(F.lit("Sound class:"), printed)


def strip_line_end(value: Column) -> Column:
    return F.rtrim(value, F.lit("\r\n"))


def alert_flag(labels: Column, patterns: tuple[str, ...]) -> Column:
    """1 when any label contains any pattern (case-sensitive); an empty list gives 0."""

    def hit(label: Column) -> Column:
        found = F.lit(False)
        for pattern in patterns:
            found = found | F.contains(label, F.lit(pattern))
        return found

    return F.coalesce(F.exists(labels, hit), F.lit(False)).cast("int")


def print_predictions(predictions: Column) -> Column:
    """The list text of the detection log: `[('Speech', 0.94), ("Children's", 0.2)]`."""

    def quoted(label: Column) -> Column:
        escaped = F.replace(label, F.lit("\\"), F.lit("\\\\"))
        plain = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
        double = F.concat(F.lit('"'), escaped, F.lit('"'))
        return F.when(F.contains(label, F.lit("'")) & ~F.contains(label, F.lit('"')), double).otherwise(plain)

    items = F.transform(
        predictions,
        lambda p: F.concat(F.lit("("), quoted(p["label"]), F.lit(", "), p["score"].cast("string"), F.lit(")")),
    )
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def parse_predictions(text: Column) -> Column:
    """Prediction array of a printed list; NULL when the text is not such a list."""

    def part(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(_ITEM), F.lit(group))

    def unescape(label: Column) -> Column:
        return F.regexp_replace(label, r"\\(.)", "$1")

    rows = F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("s"))
    parsed = F.transform(
        rows,
        lambda r: F.struct(
            unescape(F.concat(r["a"], r["b"])).alias("label"), r["s"].cast("double").alias("score")
        ),
    )
    return F.when(F.rlike(text, F.lit(_LIST)), parsed)


def predictions_json(predictions: Column) -> Column:
    """JSON list of `[label, score]` pairs."""

    def item(p: Column) -> Column:
        label = F.to_json(F.array(p["label"]))
        return F.concat(
            F.substring(label, F.lit(1), F.length(label) - 1), F.lit(", "), p["score"].cast("string"), F.lit("]")
        )

    return F.concat(F.lit("["), F.array_join(F.transform(predictions, item), ", "), F.lit("]"))


def notification(data: Column, is_text: bool) -> Column:
    """Payload of a notification: text passes through, a prediction list becomes JSON."""
    return data if is_text else predictions_json(data)
