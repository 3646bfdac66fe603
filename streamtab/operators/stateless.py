"""Stateless transforms P1-P14."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1 projection
def project(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols)


# P2 filter / P4 SQL predicate
def keep(df: DataFrame, cond) -> DataFrame:
    return df.where(F.expr(cond) if isinstance(cond, str) else cond)


# P3 filterNot.  SQL logic: a null flag is neither kept by ``filter`` nor by
# ``filterNot`` (the reference throws on it); ``observe`` counts such rows.
def drop_where(df: DataFrame, cond, observe_name=None) -> DataFrame:
    """``observe_name``: a name or a :class:`pyspark.sql.Observation`; the
    metric ``null_flag_rows`` counts rows whose flag is null (neither kept nor
    silently lost: they are reported)."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    if observe_name is not None:
        df = df.observe(observe_name, F.sum(F.when(c.isNull(), 1).otherwise(0)).alias("null_flag_rows"))
    return df.where(~c)


# P5 branch: ordered predicates, first match wins, unmatched rows get null.
def branch_id(*preds) -> Column:
    expr = None
    for i, p in enumerate(preds):
        p = F.expr(p) if isinstance(p, str) else p
        expr = F.when(p, F.lit(i)) if expr is None else expr.when(p, F.lit(i))
    return expr


def branch(df: DataFrame, *preds) -> list[DataFrame]:
    """One ``when`` chain computes the branch id once; each branch is a filter on
    it.  Each branch reads the input anew; ``branch_map`` maps all in one pass."""
    tagged = df.withColumn("__branch", branch_id(*preds))
    return [tagged.where(F.col("__branch") == i).drop("__branch") for i in range(len(preds))]


# P5 + P7 + P6 in one pass: each row takes the value of its branch; rows of no
# branch are dropped, as they would be by branching and merging.
def branch_map(df: DataFrame, preds, **cols) -> DataFrame:
    tagged = df.withColumn("__branch", branch_id(*preds)).where(F.col("__branch").isNotNull())

    def choose(values):
        out = F.when(F.col("__branch") == 0, values[0])
        for i, v in enumerate(values[1:], 1):
            out = out.when(F.col("__branch") == i, v)
        return out
    return tagged.withColumns({c: choose(v) for c, v in cols.items()}).drop("__branch")


# P6 merge: bag union by name (UNION ALL, no dedup, no order)
def merge(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


# P7 mapValues
def map_values(df: DataFrame, **cols) -> DataFrame:
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in cols.items()})


def translate(df: DataFrame, text: str = "text", prefix: str = "Translated: ") -> DataFrame:
    """The reference's stand-in translator prefixes the text."""
    return df.withColumn(text, F.concat(F.lit(prefix), F.col(text)))


# P8 flatMapValues: 0..n outputs per row, position kept (1-based).  ``keep``
# drops items before they become rows.
def flat_map(df: DataFrame, array_col, out: str = "item", pos: str = "pos", keep=None) -> DataFrame:
    items = F.transform(_c(array_col), lambda x, i: F.struct(x.alias(out), (i + 1).alias(pos)))
    if keep is not None:
        items = F.filter(items, lambda s: keep(s[out]))
    return df.select("*", F.inline(items))


# P10 selectKey: the key is just a column; the shuffle happens at the next
# group/join on it (Catalyst inserts the exchange lazily, like the reference).
def select_key(df: DataFrame, key, name: str = "key") -> DataFrame:
    return df.withColumn(name, _c(key).cast("string"))


# P11 conditional emit: forward the row, and when ``cond`` holds also a derived
# row.  ``emit_idx`` (0 = original, 1 = derived) keeps the derived row right
# after its parent in arrival order.
def emit_with_derived(df: DataFrame, cond, derived: dict) -> DataFrame:
    c = F.expr(cond) if isinstance(cond, str) else cond
    cols = df.columns
    orig = F.struct(*[F.col(x) for x in cols], F.lit(0).alias("emit_idx"))
    der = F.struct(*[(derived[x] if x in derived else F.col(x)).alias(x) for x in cols],
                   F.lit(1).alias("emit_idx"))
    arr = F.when(F.coalesce(c, F.lit(False)), F.array(orig, der)).otherwise(F.array(orig))
    return df.select(F.explode(arr).alias("__e")).select("__e.*")


# P12 foreach side effect: the testable part is the projection it prints
def greet(df: DataFrame, name: str = "value", out: str = "greeting") -> DataFrame:
    return df.select("*", F.concat(F.lit("Hello, "), F.col(name)).alias(out))


# P13 peek: observe metrics without changing the rows (a name, or an Observation)
def peek(df: DataFrame, name, *aggs: Column) -> DataFrame:
    return df.observe(name, *(aggs or (F.count(F.lit(1)).alias("rows"),)))


# P14 print with a label: the lines that are printed, as a column; ``print_labeled``
# shows them (batch) or sends them to the console sink (streaming).
def labeled(df: DataFrame, label: str, key: str, value, out: str = "line") -> DataFrame:
    return df.withColumn(out, F.concat(F.lit(f"[{label}]: "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(", "),
                                       F.coalesce(_c(value).cast("string"), F.lit("null"))))


def print_labeled(df: DataFrame, label: str, key: str, value, n: int = 20, checkpoint: str | None = None):
    """Debugging aid: ``n`` lines of a batch frame, or of every micro-batch of a stream
    (returns the running query)."""
    lines = labeled(df, label, key, value).select("line")
    if not df.isStreaming:
        return lines.show(n, truncate=False)
    w = lines.writeStream.format("console").option("numRows", n).option("truncate", "false")
    return (w.option("checkpointLocation", checkpoint) if checkpoint else w).trigger(availableNow=True).start()
