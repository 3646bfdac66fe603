"""Scalar functions F1-F12.  All are built-in Column expressions (whole-stage
codegen, no Python in the hot path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 null fallback
def ifnull(a, b) -> Column:
    return F.coalesce(_c(a), _c(b))


# F2 null-safe struct field access: a null struct gives a null field
def field(struct_col, name: str) -> Column:
    return _c(struct_col).getField(name)


# F3 struct construction with named fields
def make_struct(**fields) -> Column:
    """Columns stay columns; plain Python values become literals."""
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


# F4 tokenizer of the entity-sentiment flow: lower case, drop '#', split on a
# single space.  Empty tokens are kept (two spaces give an empty token).
def tokens(text) -> Column:
    return F.split(F.replace(F.lower(_c(text)), F.lit("#"), F.lit("")), " ", -1)


# F5 membership in a tracked list (exact token match)
def tracked(token, values) -> Column:
    return _c(token).isin(list(values))


# F6 deterministic sentiment scores, one per mention.  The reference draws three
# uniform numbers in [0, 1); a deterministic function of (id, position) keeps
# results reproducible and checkable.  ``seed`` switches to ``rand(seed)``.
def sentiment_scores(id_col, pos_col, seed: int | None = None) -> dict[str, Column]:
    if seed is not None:
        return {"sentiment_score": F.rand(seed), "sentiment_magnitude": F.rand(seed + 1),
                "salience": F.rand(seed + 2)}
    i, p = _c(id_col).cast("long"), _c(pos_col).cast("long")
    return {
        "sentiment_score": F.pmod(i * 31 + p * 17, F.lit(1000)) / F.lit(1000.0),
        "sentiment_magnitude": F.pmod(i * 13 + p * 7, F.lit(1000)) / F.lit(1000.0),
        "salience": F.pmod(i * 7 + p * 29, F.lit(1000)) / F.lit(1000.0),
    }


# F9 enum constants: unknown text maps to null, like the reference's JSON reader
def enum_value(col, allowed) -> Column:
    c = _c(col)
    return F.when(c.isin(list(allowed)), c)


# F10 whole days between two instants, truncating (not calendar midnights)
def whole_days_between(later, earlier) -> Column:
    micros_between = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    day = F.lit(86_400_000_000)
    return ((micros_between - micros_between % day) / day).cast("long")


# F11 number -> string key
def as_key(col) -> Column:
    return _c(col).cast("string")


# F12 parse time by pattern -> see streamtab.sources.declared.parse_time
def micros(ts) -> Column:
    """Timestamp -> epoch microseconds (a numeric order column for scans)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


__all__ = ["ifnull", "field", "make_struct", "tokens", "tracked", "sentiment_scores",
           "enum_value", "whole_days_between", "as_key", "micros"]
