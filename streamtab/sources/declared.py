"""Declared streams (S5): schema + event-time column parsed from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_time(col: str | Column, fmt: str | None = DEFAULT_TS_FORMAT) -> Column:
    """Text -> timestamp without zone.  ``fmt=None`` parses ISO-8601 instants
    (``2020-11-23T09:02:00.000Z``) and normalises them to UTC wall time.
    Unparseable text gives null (``try_`` semantics), never an exception."""
    c = F.col(col) if isinstance(col, str) else col
    if fmt is None:
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def format_time(col: str | Column, fmt: str = DEFAULT_TS_FORMAT) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, fmt)


def declare_stream(df: DataFrame, key: str | None = None, timestamp: str | None = None,
                   timestamp_format: str | None = DEFAULT_TS_FORMAT, event_time: str = "event_ts",
                   watermark: str | None = None) -> DataFrame:
    """Equivalent of ``CREATE STREAM ... WITH (KEY, TIMESTAMP, TIMESTAMP_FORMAT)``.

    ``key`` aliases a column as ``rowkey``; ``timestamp`` names the column that
    carries event time.  On a streaming frame ``watermark`` (e.g. "10 minutes")
    adds the watermark used by grace periods.
    """
    out = df
    if key:
        out = out.withColumn("rowkey", F.col(key).cast("string"))
    if timestamp:
        out = out.withColumn(event_time, parse_time(timestamp, timestamp_format))
        if watermark:
            out = out.withWatermark(event_time, watermark)
    return out
