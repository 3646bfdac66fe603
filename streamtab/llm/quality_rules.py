"""Quality rules combined by weak supervision.

Every rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation
over the vote patterns of all documents estimates the share of good documents
and each rule's accuracy without labels; the posterior probability of good
decides.  DataFrame functions only: features are written once to the shared
folder, and the iterations work on the counts of vote patterns (at most 3 to
the number of rules, whatever the input).

Defined results: a null text has no words and fails the base rules; all counts
are 0 for it; a document on which every rule abstains has the prior's
posterior; repeated rows are judged each; an empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.llm import common

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPEAT_WINDOW = 8
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = ("the of and to in is that it for was on are as with be at this have from or an by not "
              "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
              "de la le et les des en un du une que est pour qui dans par sur pas au avec "
              "el los y del se las por con no para su al lo como más").split()
ITERATIONS = 30
#: Where EM starts, and its pseudo-counts: vote -> probability among good and among bad documents.
PRIOR_VOTES = {1: (0.800, 0.6), 0: (0.198, 0.2), -1: (0.002, 0.2)}
PRIOR_GOOD = 0.8
#: Weight of the pseudo-counts, as a share of the documents.
PSEUDO = 0.2
KEEP = 0.5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once (a lambda variable is not inlined)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(words: Column) -> Column:
    """The hash of every 8-word window (none for fewer than 9 words)."""
    k = REPEAT_WINDOW
    n = F.size(words) - (k - 1)
    return F.when(n > 1, _let(F.transform(words, lambda w: F.xxhash64(w)),
                              lambda h: F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(h, i, k))))
                  ).otherwise(F.array().cast("array<bigint>"))


def covered_words(wins: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    k = REPEAT_WINDOW
    by_hash = F.array_sort(F.transform(wins, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return _let(by_hash, lambda at: _let(
        F.array_sort(F.transform(
            F.filter(at, lambda x, j: (F.get(at, j - 1)["h"] == x["h"]) | (F.get(at, j + 1)["h"] == x["h"])), lambda x: x["i"])),
        lambda pos: F.aggregate(
            F.transform(pos, lambda p, j: F.least(F.coalesce(F.get(pos, j + 1) - p, F.lit(k)), F.lit(k))),
            F.lit(0).cast("long"), lambda acc, x: acc + x)))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the counts the rules read, per row."""
    t = F.coalesce(F.col("t"), F.lit(""))
    rows = (docs.select(F.col(key), F.col(text).alias("t")).withColumn("w", words_of(t))
            .withColumn("lines", F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)))
    base = rows.select(
        key, F.size("w").cast("long").alias("n_words"), F.length(F.translate(t, WHITE, "")).cast("long").alias("word_chars"),
        _count_chars(t, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), _count_chars(t, UPPER).cast("long").alias("n_upper"),
        F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in STOP_WORDS]))).cast("long").alias("n_stop"),
        window_hashes(F.col("w")).alias("wins"))
    once = F.size(F.array_distinct("wins")) == F.size("wins")
    return base.select("*", F.when(once, F.lit(0).cast("long")).otherwise(covered_words(F.col("wins"))).alias("n_repeat_words")).drop("wins")


def rules() -> dict[str, Column]:
    """name -> vote: 1 good, -1 bad, 0 abstains."""
    n, c = F.col("n_words"), F.col("word_chars")

    def vote(good, bad):
        return F.when(n == 0, 0).when(good, 1).when(bad, -1).otherwise(0)
    return {
        "word_length": vote((c >= 3 * n) & (c <= 10 * n), (c < 2 * n) | (c > 14 * n)),
        "symbols": vote(50 * F.col("n_symbols") <= n, 10 * F.col("n_symbols") >= 3 * n),
        "dup_lines": vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 2), 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "stop_words": vote(F.col("n_stop") >= 3, (F.col("n_stop") == 0) & (n >= 40)),
        "capitals": vote(5 * F.col("n_upper") <= c, 2 * F.col("n_upper") > c),
        "repeats": vote(F.col("n_repeat_words") == 0, 5 * F.col("n_repeat_words") > n),
        "size": vote(n >= 50, n < 20),
    }


def em(patterns: list[tuple[tuple[int, ...], int]], iterations: int = ITERATIONS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """(share of good documents, per rule: vote -> its probability among good
    and among bad documents) from (votes, number of documents).

    A rule is right in two ways, by voting good on good documents and bad on bad
    ones, so both accuracies are estimated; PRIOR_VOTES enters as pseudo-counts
    in proportion to the input (the same at every size) and tells the classes apart.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    total = float(sum(n for _, n in patterns))
    share, tables = PRIOR_GOOD, [dict(PRIOR_VOTES) for _ in range(n_rules)]
    for _ in range(iterations):
        good = 0.0
        sums = [{v: [PSEUDO * total * c for c in cs] for v, cs in PRIOR_VOTES.items()} for _ in range(n_rules)]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-log_odds(votes, share, tables)))
            good += n * p
            for s, v in zip(sums, votes):
                s[v][0] += n * p
                s[v][1] += n * (1 - p)
        if total:
            share = min(max((good + PSEUDO * total * PRIOR_GOOD) / (total * (1 + PSEUDO)), 0.01), 0.99)
            tables = [{v: (c[0] / sum(x[0] for x in s.values()), c[1] / sum(x[1] for x in s.values())) for v, c in s.items()} for s in sums]
    return share, tables


def log_odds(votes, share: float, tables) -> float:
    z = math.log(share / (1 - share)) + sum(math.log(t[v][0] / t[v][1]) for v, t in zip(votes, tables) if v)
    return max(-500.0, min(500.0, z))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """The features, base_failed, quality (posterior probability of good) and kept per row."""
    spark = docs.sparkSession
    common.prepare(spark)
    named = rules()
    voted = common.materialize(features(docs, key, text).withColumns({f"vote_{k}": v for k, v in named.items()}), "votes")
    names = [f"vote_{k}" for k in named]
    share, tables = em([(tuple(r[c] for c in names), r.n) for r in voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()])
    z = F.lit(math.log(share / (1 - share)))
    for c, t in zip(names, tables):
        z = z + F.when(F.col(c) > 0, math.log(t[1][0] / t[1][1])).when(F.col(c) < 0, math.log(t[-1][0] / t[-1][1])).otherwise(0.0)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (voted.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-z)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep)))
