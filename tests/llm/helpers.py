"""Small documents tables and edge rows shared by the tests."""

import random

EDGE = [
    (9001, None, "en", "s", None), (9002, "", "en", "s", 0), (9003, " \n\t ", None, "s", 4), (None, "plain words without an id here", "en", None, 1),
    (9004, "!!! *** ###", "en", "s", 11), (9005, "one", "en", "s", 3), (9006, "repeated row of words", "en", "s", 1),
    (9006, "repeated row of words", "en", "s", 1), (9007, "été übung niño größe", "fr", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, stems=("lor", "mip", "tan", "ger", "vos", "quil", "den", "fra")) -> list[str]:
    return ["".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df, *names):
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("mine") for n in names})
