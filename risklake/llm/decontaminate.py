"""Benchmark passages in documents, by winnowing. DataFrame functions only.

A window is ``WINDOW`` consecutive words (A-Z lower-cased) of a benchmark item; an item of fewer
words is one window. A document word inside an occurrence of a window is hit.

Winnowing keeps the least ``GRAM``-word hash of every ``WINDOW`` words, on both sides, so that
documents and items that share a window share a fingerprint. Fingerprints of documents are
looked up in those of the items while the documents are read; only documents with one in common
go on. There a hit is extended to whole windows: all windows of the document are compared with
the items' by two 64-bit hashes. Items shorter than a window are looked up by all word groups
of their length.

The items' fingerprints and windows are broadcast when there are ``BROADCAST_ROWS`` at most,
which is counted first; beyond that they are joined by shuffles.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.session import cut_lineage

WINDOW = 10
GRAM = 5
#: Up to so many rows of 40 bytes are broadcast.
BROADCAST_ROWS = 500_000
#: Bytes between words: all of ASCII but digits and lower-case letters. A fixed value.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; of null, none."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, BETWEEN), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _grams(hashes: Column, size: int) -> Column:
    """A hash for every ``size`` consecutive word hashes."""
    all_grams = F.transform(hashes, lambda _, i: F.xxhash64(F.slice(hashes, i + 1, size)))
    return F.slice(all_grams, 1, F.greatest(F.size(hashes) - size + 1, F.lit(0)))


def fingerprints(hashes: Column) -> Column:
    """The least gram hash of every window of a text, each value once."""
    span = WINDOW - GRAM + 1
    least = lambda g: F.transform(g, lambda _, i: F.array_min(F.slice(g, i + 1, span)))
    whole = lambda g: F.slice(least(g), 1, F.greatest(F.size(g) - span + 1, F.lit(0)))
    return F.array_distinct(_let(_grams(hashes, GRAM), whole))


def _windows(hashes: Column, size: int) -> Column:
    """(pos, size, h0, h1) of every group of ``size`` words."""
    group = lambda i: F.slice(hashes, i + 1, size)
    every = F.transform(hashes, lambda _, i: F.struct(
        i.alias("pos"), F.lit(size).alias("size"),
        F.xxhash64(group(i)).alias("h0"), F.xxhash64(F.lit(size), group(i)).alias("h1"),
    ))
    return F.slice(every, 1, F.greatest(F.size(hashes) - size + 1, F.lit(0)))


def _sized(df: DataFrame) -> DataFrame:
    """With a broadcast hint, if it is small enough to go to every executor."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def hit_windows(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs (id, key, text), items (item_id, text): per document (id, key, n_words), and
    (id, key, pos, size, item_id) of every benchmark window in it."""
    tested = items.where("text IS NOT NULL").select("item_id", word_hashes(F.col("text")).alias("w")).where("size(w) > 0")
    short = sorted(r[0] for r in tested.where(F.size("w") < WINDOW).select(F.size("w")).distinct().collect())
    sizes = [WINDOW, *short]  # ten lengths at most
    of_size = lambda n: F.size("w") == n if n < WINDOW else F.size("w") >= n
    windows = None
    for n in sizes:
        part = tested.where(of_size(n)).select("item_id", F.explode(_windows(F.col("w"), n)).alias("x")).select("item_id", "x.size", "x.h0", "x.h1")
        windows = part if windows is None else windows.unionByName(part)
    windows = _sized(windows.distinct())

    def prints(w: Column, lengths: list[int]) -> Column:
        parts = [F.transform(fingerprints(w), lambda f: F.struct(F.lit(WINDOW).alias("kind"), f.alias("f")))]
        parts += [
            F.transform(F.array_distinct(_grams(w, n)), lambda f, n=n: F.struct(F.lit(n).alias("kind"), f.alias("f")))
            for n in lengths
        ]
        return F.concat(*parts)

    own = None
    for n in sizes:
        of = fingerprints(F.col("w")) if n == WINDOW else _grams(F.col("w"), n)
        part = tested.where(of_size(n)).select(F.lit(n).alias("kind"), F.explode(of).alias("f"))
        own = part if own is None else own.unionByName(part)
    own = _sized(own.distinct().withColumn("found", F.lit(True)))

    hashed = docs.select("id", "key", word_hashes(F.col("text")).alias("w"))
    looked_up = cut_lineage(
        hashed.select("id", "key", _let(F.col("w"), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), prints(w, short).alias("p"))).alias("x"))
        .select("id", "key", "x.n_words", F.explode_outer("x.p").alias("p"))
        .select("id", "key", "n_words", "p.kind", "p.f")
        .join(own, ["kind", "f"], "left")
        .groupBy("id", "key").agg(F.max("n_words").alias("n_words"), F.max("found").alias("found"))
    )
    some = docs.join(looked_up.where("found").select("id", "key"), ["id", "key"]).select("id", "key", word_hashes(F.col("text")).alias("w"))
    all_windows = lambda w: F.concat(*[_windows(w, n) for n in sizes])
    hits = (
        some.select("id", "key", F.explode(_let(F.col("w"), all_windows)).alias("x")).select("id", "key", "x.*")
        .join(windows, ["size", "h0", "h1"])
        .select("id", "key", "pos", "size", "item_id")
    )
    return looked_up, hits


def _covered(spans: Column) -> Column:
    """How many words lie in spans (pos, size) sorted by place."""
    start = F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n"))

    def add(done, span):
        stop = span["pos"] + span["size"]
        more = F.greatest(stop - F.greatest(span["pos"], done["stop"]), F.lit(0))
        return F.struct(F.greatest(stop, done["stop"]).alias("stop"), (done["n"] + more).alias("n"))

    return F.aggregate(spans, start, add, lambda done: done["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``key`` (a hash of the text), ``n_words``,
    ``n_hit``, ``item_ids`` (sorted strings of the items with occurring windows) and
    ``contaminated``.

    Null and empty texts have no words. Ids may be null or repeat: rows are told apart by id and
    text. Items without words, or with a null text, match nothing; a null ``item_id`` counts as
    the string "null". Other columns of either table are not read.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    # A row with a null id takes part under a number of its own side, so that joins on the id hold.
    told = keyed.withColumns({"none": F.col("id").isNull(), "id": F.coalesce(F.col("id").cast("string"), F.lit(""))})
    rows = told.withColumn("id", F.struct("none", "id")).drop("none")
    counted, hits = hit_windows(rows, named)
    found = hits.groupBy("id", "key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        _covered(F.array_sort(F.collect_set(F.struct("pos", "size")))).alias("n_hit"),
    )
    per_text = counted.drop("found").join(found, ["id", "key"], "left")
    return (
        rows.select("id", "key").join(per_text, ["id", "key"], "left")
        .select(
            F.when(F.col("id.none"), None).otherwise(F.col("id.id")).cast(docs.schema[id_col].dataType).alias(id_col),
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
