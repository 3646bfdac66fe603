"""Typed JSON decode/encode (S6, S7), keyed text lines (S8), malformed-record policy.

Schemas are declared, never inferred.  Unknown JSON fields are dropped by the
schema itself, which doubles as projection.  Field-name policies map the wire
names (UpperCamel or lower_snake) to the column names used downstream.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def snake(name: str) -> str:
    """``CreatedAt`` -> ``created_at``; already-snake names are unchanged."""
    s = re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name)
    return s.lower()


def decode(col: str | Column, schema: T.StructType, naming: str = "as_is",
           mode: str = "PERMISSIVE") -> Column:
    """Parse a JSON text column into a struct of ``schema``.

    ``naming="upper_camel"`` reads wire names such as ``CreatedAt`` and returns
    snake_case fields; ``mode`` is the reader mode (``PERMISSIVE`` gives null
    fields for a malformed record, ``FAILFAST`` raises).
    """
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.from_json(c, schema, {"mode": mode})
    if naming == "as_is":
        return parsed
    renamed = F.struct(*[parsed[f.name].alias(snake(f.name)) for f in schema.fields])
    return F.when(parsed.isNotNull(), renamed)          # a null text (a tombstone) stays null


def decode_columns(df: DataFrame, col: str, schema: T.StructType, naming: str = "as_is",
                   keep: list[str] | None = None) -> DataFrame:
    """Decode ``col`` and flatten the struct into top-level columns."""
    keep = keep or []
    return df.select(*keep, decode(col, schema, naming).alias("__v")).select(*keep, "__v.*")


def encode(*cols: str | Column) -> Column:
    """Encode columns as one JSON object (S7).  Null fields are omitted, the
    same policy as the reference's JSON writer."""
    return F.to_json(F.struct(*cols))


def split_keyed_line(line: str | Column = "value", sep: str = "|") -> tuple[Column, Column]:
    """Split ``key<sep>json`` on the *first* separator only."""
    c = F.col(line) if isinstance(line, str) else line
    parts = F.split(c, re.escape(sep), 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))   # no separator: a null value


def decode_keyed_text(df: DataFrame, schema: T.StructType, line: str = "value",
                      key_type: str = "string", sep: str = "|", keep: list[str] | None = None) -> DataFrame:
    """``read.text`` output -> ``key`` + the columns to keep + typed value columns."""
    k, v = split_keyed_line(line, sep)
    keep = keep or []
    return (df.select(k.cast(key_type).alias("key"), *keep, F.from_json(v, schema).alias("__v"))
              .select("key", *keep, "__v.*"))


def with_corrupt_flag(df: DataFrame, col: str, schema: T.StructType, out: str = "parsed") -> DataFrame:
    """Parse ``col`` with a corrupt-record column (S9 'log and continue').

    Adds ``out`` (the struct, fields null when malformed) and ``is_malformed``.
    Splitting good and bad rows is then two filters on one plan: no second read.
    """
    with_c = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(col), with_c, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (df.withColumn("__p", parsed)
              .withColumn("is_malformed", F.col(col).isNotNull() & F.col(f"__p.{CORRUPT}").isNotNull())
              .withColumn(out, F.col("__p").dropFields(CORRUPT))
              .drop("__p"))


def split_malformed(df: DataFrame, col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, dead_letter) frames of one decode; FAILFAST is ``decode(mode='FAILFAST')``."""
    flagged = with_corrupt_flag(df, col, schema)
    return flagged.where(~F.col("is_malformed")), flagged.where(F.col("is_malformed"))
