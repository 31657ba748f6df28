"""Rules of the text functions that hold for every value and every session time zone."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from acoustic_spark.functions.text import epoch_seconds, record_name, two_decimals
from acoustic_spark.operators.toplists import top_n_per_key


def test_two_decimals_of_any_number(spark):
    rng = random.Random(3)
    scores = [2.675, 1.005, -0.125, 0.125, -0.001, 1.0, 0.999999, 99.995, 123456789.125, 2.0**52 + 0.5, 2.0**53, 1e-320]
    scores += [rng.uniform(-50, 50) for _ in range(300)] + [k / 8 for k in range(-40, 40)]
    got = spark.createDataFrame([(s,) for s in scores], "s DOUBLE").select("s", two_decimals(F.col("s")).alias("t")).collect()
    assert [(r.s, r.t) for r in got] == [(s, f"{s:.2f}") for s in scores]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_record_name_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    times = [datetime(2024, 1, 1, 0, 0, 7), datetime(2024, 3, 10, 2, 30), datetime(2024, 7, 1)]
    df = spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [r[0] for r in df.select(record_name(epoch_seconds(F.col("ts")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [f"record_{int((t - datetime(1970, 1, 1)).total_seconds())}.wav" for t in times]


def test_long_top_lists(spark):
    rows = spark.range(3000).select(F.lit("a").alias("k"), "id")
    top = top_n_per_key(rows, ["k"], [F.desc("id")], 1001)
    assert sorted(r.id for r in top.collect()) == list(range(1999, 3000))
    with pytest.raises(ValueError):
        top_n_per_key(rows, ["k"], [F.desc("id")], 0)
