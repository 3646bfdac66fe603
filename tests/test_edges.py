"""Edges of parsing, time differences and session set-up."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.functions.scalars import whole_days_between
from streamtab.session import ensure_checkpoint_dir
from streamtab.sources.json_codec import decode, split_keyed_line


def test_keyed_line_without_separator(spark):
    df = spark.createDataFrame([("a|{}",), ("no separator",), ("",), (None,)], "value string")
    k, v = split_keyed_line()
    assert [tuple(r) for r in df.select(k, v).collect()] == [("a", "{}"), ("no separator", None), ("", None), (None, None)]


def test_null_text_decodes_to_null(spark):
    schema = T.StructType([T.StructField("CreatedAt", T.LongType())])
    df = spark.createDataFrame([(None,), ('{"CreatedAt": 5}',)], "v string")
    got = [r[0] for r in df.select(decode("v", schema, "upper_camel").alias("x")).collect()]
    assert got[0] is None and got[1].created_at == 5


def test_whole_days_keep_fractions_of_a_second(spark):
    rows = [("2024-01-01 00:02:01.900", "2024-01-08 00:02:01.100", 6), ("2024-01-01 00:02:01.900", "2024-01-08 00:02:01.900", 7),
            ("2024-01-08 00:00:00", "2024-01-01 00:00:00.000001", -6)]
    df = spark.createDataFrame(rows, "a string, b string, want long")
    got = df.select(whole_days_between(F.col("b").cast("timestamp"), F.col("a").cast("timestamp")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_cluster_without_a_shared_folder_is_refused():
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=SimpleNamespace(master="spark://x:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_twin_inputs_follow_the_record_type(spark):
    from streamtab.operators import state
    schema = "key long, seq long, wind_speed_mph double, power string, type string"
    rep = spark.createDataFrame([(1, 1, 70.0, "ON", "REPORTED"), (1, 2, 5.0, "OFF", None)], schema)
    des = spark.createDataFrame([(1, 3, 6.0, "ON", "REPORTED")], schema)
    cols = ["wind_speed_mph", "power"]
    r = state.twin_latest(state.twin_inputs(rep, des), "key", ["seq", "emit_idx"], cols).first()
    assert tuple(r.desired) == (70.0, "OFF") and tuple(r.reported) == (6.0, "ON")
