"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. Three letters in a row are bound: the
vectors, permuted by their place, are multiplied. The n-gram vectors of a language's texts are
bundled (summed) into its prototype; a text is compared with the prototypes by cosine.

A text's own bundle is never built: its product with a prototype is the sum of its n-grams'
products, which a worker works out once for each n-gram. Its norm, alike for all languages, is
taken as that of a sum of orthogonal vectors, sqrt(D * sum of squared counts); n-gram vectors of
D = ``DIMENSIONS`` are orthogonal but for a relative error of 1 / sqrt(D).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.pretokens import LETTER, _kinds
from risklake.llm.words import blocks, mix, utf8

DIMENSIONS = 2048
#: Stands for what lies between words.
GAP = 0x20
#: N-grams whose products a worker keeps; all are forgotten when there are more.
KEPT_NGRAMS = 200_000
UNKNOWN = "und"
#: Documents are for learning unless this remainder of their id's crc32 is 0.
FOLDS = 5


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


@lru_cache(maxsize=4096)
def _letter(point: int) -> np.ndarray:
    """The vector of a letter: bits of a mixed counter as +1 and -1."""
    counter = np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.uint64(point << 20)
    bits = np.unpackbits(mix(mix(counter) + np.uint64(0x632BE59BD9B4E019)).view(np.uint8))
    return bits.astype(np.int8) * 2 - 1


def ngram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams; a code holds three code points of 21 bits."""
    points = [(codes >> np.uint64(shift)) & np.uint64(0x1FFFFF) for shift in (42, 21, 0)]
    out = np.ones((len(codes), DIMENSIONS), np.int8)
    for turn, column in zip((2, 1, 0), points):
        unique, which = np.unique(column, return_inverse=True)
        if len(unique):
            out *= np.stack([np.roll(_letter(int(p)), turn) for p in unique])[which]
    return out


def ngram_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of the n-grams in every text, and which rows have a letter.

    Texts are lower-cased; all that isn't a letter is one gap, also before and behind a text.
    """
    data, offsets = utf8(pc.utf8_lower(column))
    text = data.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    bounds = np.searchsorted(place, offsets)
    is_letter = _kinds()[points] == LETTER
    # A gap between rows, then every run of gaps as one.
    row = np.repeat(np.arange(len(column)), np.diff(bounds) + 1)
    padded = np.full(len(points) + len(column), GAP, np.uint64)
    spot = np.arange(len(points)) + np.repeat(np.arange(len(column)), np.diff(bounds)) + 1
    padded[spot] = np.where(is_letter, points, GAP)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != GAP) | (padded[:-1] != GAP)
    first_of_row = np.concatenate([[0], np.cumsum(np.diff(bounds) + 1)[:-1]]).astype(np.int64) if len(column) else np.empty(0, np.int64)
    keep[first_of_row] = True
    letters, row = np.append(padded[keep], np.uint64(GAP)), np.append(row[keep], len(column))
    codes = (letters[:-2] << np.uint64(42)) | (letters[1:-1] << np.uint64(21)) | letters[2:]
    # The third letter may be the gap that opens the next row; the second may not.
    inside = (row[:-2] == row[1:-1]) & (letters[1:-1] != GAP)
    codes, row = codes[inside], row[:-2][inside]
    known, which = np.unique(codes, return_inverse=True)
    pair, count = np.unique(row * max(1, len(known)) + which, return_counts=True)
    has = np.zeros(len(column), bool)
    has[np.unique(row)] = True
    return pair // max(1, len(known)), known[pair % max(1, len(known))], count, has


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """A bundle for every language of ``docs`` (lang, text), both not null.

    Each task sends one vector a language; these are summed in two steps.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[int, int]] = {}
        for batch in batches:
            for block in blocks(batch):
                langs = np.array(block.column("lang").to_pylist(), object)
                row, codes, count, _ = ngram_counts(block.column("text"))
                for lang in set(langs.tolist()):
                    mine = (langs == lang)[row]
                    known, which = np.unique(codes[mine], return_inverse=True)
                    total = np.bincount(which, count[mine], len(known)).astype(np.int64)
                    held = counts.setdefault(lang, {})
                    for code, n in zip(known.tolist(), total.tolist()):
                        held[code] = held.get(code, 0) + n
        out = []
        for held in counts.values():
            codes, n = np.fromiter(held, np.uint64, len(held)), np.fromiter(held.values(), np.float64, len(held))
            total = np.zeros(DIMENSIONS)
            for at in range(0, len(codes), 2048):
                total += n[at : at + 2048] @ ngram_vectors(codes[at : at + 2048])
            out.append(total)
        yield pa.record_batch({"lang": pa.array(list(counts), pa.string()), "vector": pa.array([v.tolist() for v in out], pa.list_(pa.float64()))})

    def add(table: pa.Table) -> pa.Table:
        vectors = np.stack([np.asarray(v, float) for v in table.column("vector").to_pylist()])
        return pa.table({"lang": table.column("lang")[:1], "vector": pa.array([vectors.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    kind = "lang string, vector array<double>"
    parts = docs.mapInArrow(bundle, kind)
    some = parts.groupBy("lang", (F.spark_partition_id() % 64).alias("part")).applyInArrow(add, kind)
    rows = some.groupBy("lang").applyInArrow(add, kind).collect()
    return {r["lang"]: np.array(r["vector"]) for r in sorted(rows, key=lambda r: r["lang"])}


class _Products:
    """Products of n-grams with the prototypes of length 1, as met; bounded."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.clear()

    def clear(self) -> None:
        self.codes = np.empty(0, np.uint64)
        self.values = np.empty((0, self.matrix.shape[1]))

    def of(self, codes: np.ndarray) -> np.ndarray:
        known, which = np.unique(codes, return_inverse=True)
        new = np.setdiff1d(known, self.codes, assume_unique=True)
        if len(new):
            if len(self.codes) + len(new) > KEPT_NGRAMS:
                self.clear()
                new = known
            fresh = np.concatenate([ngram_vectors(new[a : a + 2048]) @ self.matrix for a in range(0, len(new), 2048)])
            both = np.concatenate([self.codes, new])
            order = np.argsort(both)
            self.codes, self.values = both[order], np.concatenate([self.values, fresh])[order]
        return self.values[np.searchsorted(self.codes, known)][which]


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with lang_pred and score, the cosine cut to 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if there
    are no profiles. Ties go to the first language by name. Columns so named are replaced.
    """
    source = docs.drop("lang_pred", "score")
    kept = source.columns
    langs = sorted(profiles)
    matrix = np.stack([profiles[n] / max(np.linalg.norm(profiles[n]), 1e-12) for n in langs], axis=1) if langs else None
    shared = docs.sparkSession.sparkContext.broadcast(matrix)  # languages x DIMENSIONS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = _Products(shared.value.astype(np.float32)) if langs else None
        names = np.array([*langs, UNKNOWN], object)
        for batch in batches:
            for block in blocks(batch, text_col):
                n = block.num_rows
                best, score = np.full(n, len(langs)), np.zeros(n)
                if langs:
                    row, codes, count, has = ngram_counts(block.column(text_col))
                    dots = products.of(codes) * count[:, None]
                    total = np.stack([np.bincount(row, d, n) for d in dots.T], axis=1)
                    norm = np.sqrt(DIMENSIONS * np.bincount(row, count.astype(float) ** 2, n))
                    cosine = total[has] / norm[has][:, None]
                    best[has] = cosine.argmax(axis=1)
                    score[has] = np.clip(cosine.max(axis=1), 0, 1)
                yield pa.record_batch({c: block.column(c) for c in kept} | {
                    "lang_pred": pa.array(names[best].tolist(), pa.string()),
                    "score": pa.array(score, pa.float64()),
                })

    schema = ", ".join([f"`{n}` {t}" for n, t in source.dtypes] + ["lang_pred string, score double"])
    return source.mapInArrow(run, schema)


def learn_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, lang_pred and score. Learns from the
    documents that aren't held out and whose text and language aren't null; a null id is held
    out. Predictions see the text only."""
    told = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(held_out(id_col), F.lit(True)).alias("held_out"),
    )
    taught = told.where("NOT held_out AND text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    return identify(told.select(id_col, "text", "held_out"), prototypes(taught)).drop("text")
