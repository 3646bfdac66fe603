"""URL filters: host-suffix / path-prefix expressions joined on hash prefixes.

Every URL is expanded into the expressions ``host suffix + path prefix`` that a
rule could have (only the label counts and path lengths that occur in the
rules), each expression is hashed, expressions and rules are equi-joined on a
short prefix of the hash, and the full digest confirms the hit.  DataFrame
functions only.

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no rule; a rule whose host or path is null never fits; equal rules
with both verdicts count as ``block``; repeated rows are judged each; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest used as the join key (32 bits).
PREFIX_HEX = 8
#: Rules up to this many are broadcast (fixed-width digests and verdicts).
BROADCAST_RULES = 100_000
OUT = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(h, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _keys(expr: Column) -> list[Column]:
    return [F.sha2(expr, 256).alias("digest"), F.substring(F.sha2(expr, 256), 1, PREFIX_HEX).alias("prefix")]


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule (``host + path`` of the rule that decides, or null)
    and verdict to every row; the longest fitting rule wins, ``default`` holds
    where none fits.  Input columns named like these four are replaced.

    ``rules``: host, path, verdict.  The set of (label count, path length)
    shapes of the rules is collected: at most 127 labels by the path lengths of
    real URLs, whatever the number of rules.
    """
    r = (rules.where("host is not null and path is not null")
         .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
         .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
         .select("verdict", F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"),
                 F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_len")))
    shapes = [tuple(x) for x in r.select("labels", "path_len").distinct().collect()]
    hashed = r.select("rule", "host_len", "verdict", *_keys(F.col("rule")))
    if r.count() <= BROADCAST_RULES:
        hashed = F.broadcast(hashed)

    src = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url).alias("u"))
    parsed = (src.where(F.col("u").contains("://")).select("u").distinct()
              .select("u", F.split(host_of(F.col("u")), r"\.").alias("labels"), path_of(F.col("u")).alias("path")))
    tried = [F.when((F.size("labels") >= n) & (F.length("path") >= k),
                    F.concat(F.array_join(F.slice("labels", -n, n), "."), F.substring("path", 1, k)))
             for n, k in sorted(shapes)] or [F.lit(None).cast("string")]
    expr = parsed.select("u", F.explode(F.array_compact(F.array(*tried))).alias("expr")).select("u", *_keys(F.col("expr")))
    hits = (expr.alias("e").join(hashed.alias("r"), "prefix").where("e.digest = r.digest")
            .groupBy("u").agg(F.max(F.struct(F.length("rule").alias("n"), "host_len", "verdict", "rule")).alias("best")))
    joined = src.join(hits, "u", "left")
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in OUT],
                         host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"),
                         F.col("best.rule").alias("rule"),
                         F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
