"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are word ids of the benchmark vocabulary (0: not in it).  For each
pattern length m (the window, or the length of a shorter item) there is one
shift table over blocks of two words: a position whose block cannot end a
pattern is skipped by the smallest safe distance.  Where the shift is 0, the
bucket of that suffix block selects the patterns with the same first word pair,
and a direct comparison confirms each occurrence.

Benchmarks of any size: the distinct windows are dealt into blocks of at most
``block_windows``; every block is one broadcast of bounded size and one narrow
pass over the documents, without a shuffle.  Hits of the passes are merged per
row.

Defined results: a null or empty text has no words and no hits; a null item
text has no windows; item ids are compared as strings (null ids are ignored);
repeated rows are searched each; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.llm import common

#: Distinct (window, item) pairs per broadcast block (about 100 bytes each).
BLOCK_WINDOWS = 200_000
#: Bytes that belong to words after lower-casing A-Z: digits, a-z and all non-ASCII; others become spaces.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))

OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                    T.StructField("items", T.ArrayType(T.StringType())),
                    T.StructField("hit_spans", T.ArrayType(T.LongType()))])


def words_of(body: bytes | None) -> list[bytes]:
    return body.translate(WORD_TABLE).split() if body else []


def windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct (window, item_id) pairs; the window is its words joined by a space."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")
    base = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("item"), w.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return base.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, width), " "))).alias("window")).distinct()


class WuManber:
    """Shift tables, suffix buckets and patterns of one block of windows."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple, list[str]] = defaultdict(list)
        for window, item in pairs:
            owners[tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in window.split(b" "))].append(item)
        self.owners = dict(owners)
        self.tables = []
        by_len = defaultdict(list)
        for p in self.owners:
            by_len[len(p)].append(p)
        for m, patterns in sorted(by_len.items()):
            b = min(2, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[tuple, list]] = {}
            for p in patterns:
                for end in range(b, m + 1):
                    block = p[end - b:end]
                    shift[block] = min(shift.get(block, m), m - end)
                buckets.setdefault(p[m - b:], {}).setdefault(p[:b], []).append(p)
            self.tables.append((m, b, shift, buckets))

    def find(self, words: list[bytes]) -> list[tuple[int, tuple]]:
        """(start, pattern) of every occurrence."""
        get = self.ids.get
        seq = [get(w, 0) for w in words]
        n, found = len(seq), []
        for m, b, shift, buckets in self.tables:
            most, end = m - b + 1, m
            while end <= n:
                block = tuple(seq[end - b:end])
                s = shift.get(block, most)
                if s:
                    end += s
                    continue
                start = end - m
                for p in buckets[block].get(tuple(seq[start:start + b]), ()):
                    if tuple(seq[start:end]) == p:
                        found.append((start, p))
                end += 1
        return found


def _search(pairs):
    def make():
        wm = WuManber([(w.encode(), i) for w, i in pairs.value])

        def run(bodies):
            n_words, n_hit, items, spans = [], [], [], []
            for body in bodies:
                words = words_of(body)
                hit = wm.find(words)
                cover, last = 0, 0
                flat = []
                for start, p in sorted((s, -len(p)) for s, p in hit):
                    stop = start - p
                    if stop > last:
                        if flat and start <= last:
                            flat[-1] = stop
                        else:
                            flat += [start, stop]
                        cover += stop - max(start, last)
                        last = stop
                n_words.append(len(words))
                n_hit.append(cover)
                items.append(sorted({i for _, p in hit for i in wm.owners[p] if i is not None}))
                spans.append(flat)
            return n_words, n_hit, items, spans
        return run
    return make


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
           item_text: str = "text", width: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Add n_words, n_hit, items (sorted ids of items with an occurring window)
    and hit_spans (flat [start, stop) word positions) to every row.  Input
    columns with these names are replaced."""
    spark = docs.sparkSession
    common.prepare(spark)
    pairs = windows(benchmark, item_id, item_text, width)
    blocks = max(1, -(-pairs.count() // block_windows))
    out = None
    for k in range(blocks):
        mine = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast([(r.window, r.item) for r in mine.collect()])
        if out is None:
            out = common.map_text(docs, text, _search(held), OUT)
            continue
        carried = out.withColumns({f"__prev_{c}": F.col(c) for c in OUT.names[1:]})
        out = common.map_text(carried, text, _search(held), OUT)
        spans = _merge_spans(F.concat("__prev_hit_spans", "hit_spans"))
        out = (out.withColumn("items", F.array_sort(F.array_union("__prev_items", "items")))
               .withColumn("hit_spans", spans)
               .withColumn("n_hit", F.aggregate(F.sequence(F.lit(0), F.size("hit_spans") - 1), F.lit(0).cast("long"),
                           lambda a, i: a + F.when(i % 2 == 1, F.get("hit_spans", i)).otherwise(-F.coalesce(F.get("hit_spans", i), F.lit(0).cast("long")))))
               .withColumn("n_hit", F.when(F.size("hit_spans") == 0, F.lit(0).cast("long")).otherwise(F.col("n_hit")))
               .drop(*[f"__prev_{c}" for c in OUT.names[1:]]))
    return out


def _merge_spans(flat):
    """Union of flat [start, stop) lists as a flat sorted list."""
    n = F.size(flat)
    pairs = F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), n), lambda i: (i % 2 == 0) & (i < n)),
                                     lambda i: F.struct(F.get(flat, i.cast("int")).alias("a"), F.get(flat, (i + 1).cast("int")).alias("b"))))
    empty = F.array().cast("array<bigint>")

    def step(acc, p):
        last = F.get(acc, F.size(acc) - 1)
        return (F.when((F.size(acc) > 0) & (p["a"] <= last),
                       F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.greatest(last, p["b"]))))
                .otherwise(F.concat(acc, F.array(p["a"], p["b"]))))
    return F.aggregate(pairs, empty, step)


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``search``'s result."""
    return (found.withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", F.col("n_hit") > 0))


__all__ = ["search", "digest", "windows", "WuManber", "words_of"]
