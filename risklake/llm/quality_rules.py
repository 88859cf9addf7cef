"""Quality rules: counts over a text, and its divergence from language references.

References are learned from all documents with a language: the histogram of character classes,
and of the language's ``COMMON`` most common words against all others. A text is held against
every language by the Jensen-Shannon distance of either histogram and judged by the nearest; its
own language label isn't looked at. The more words, the nearer prose comes to its language, so the
limit for words falls with their number; it is below the distance of a text without any common
word. Texts shorter than ``MIN_CHARS`` or ``MIN_WORDS`` are too short for that histogram and are
not judged by it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risklake.llm.words import Words, blocks, mix, utf8, window_hashes, window_rows

MIN_KEPT_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COMMON = 100
MIN_CHARS = 200
MIN_WORDS = 40
#: A text is rejected beyond these distances (0 to 1) from the nearest language; that of words is
#: for numbers of words, in between it is on the line.
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = ((40, 120, 400), (0.465, 0.46, 0.36))
#: A task sends its counts on, and begins anew, when it holds so many different words.
COUNTED_WORDS = 200_000
#: or bytes of words beyond the 64th of each.
COUNTED_BYTES = 8_000_000
CLASSES = 8
#: The columns that ``quality`` adds.
COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept",
)


def _class_table() -> np.ndarray:
    """A class for every byte: lower case, upper case, digit, white space, sentence mark, symbol,
    beyond ASCII; the rest, and -1 for the inner bytes of a code point."""
    table = np.full(256, 7, np.int8)
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), (32, *range(9, 14)), b".,;:'\"()-?!", SYMBOLS)):
        table[list(members)] = k
    table[0xC0:] = 6
    table[0x80:0xC0] = -1
    return table


_CLASS = _class_table()


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each class in each row."""
    kinds = _CLASS[data]
    out = np.zeros((len(offsets) - 1, CLASSES), np.int64)
    for k in range(CLASSES):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kinds == k, out=total[1:])
        out[:, k] = np.diff(total[offsets])
    return out


def _common_form(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the words without sentence marks behind them."""
    ends = words.ends.copy()
    marks = np.isin(words.data[ends - 1], np.frombuffer(b".,;:?!", np.uint8)) & (ends - words.starts > 1)
    return words.starts, ends - marks


def _span_hashes(words: Words) -> np.ndarray:
    bare = Words.__new__(Words)
    bare.data = words.data
    bare.starts, bare.ends = _common_form(words)
    return bare.hashes()


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, kind, name, n) over all documents: *class* counts, *word* counts of the common
    words, and *all* words. Counts are exact."""

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [(), (), (), ()]
        return pa.record_batch({
            "lang": pa.array(cols[0], pa.string()), "kind": pa.array(cols[1], pa.string()),
            "name": pa.array(cols[2], pa.string()), "n": pa.array(cols[3], pa.int64()),
        })

    def word_rows(words_of: dict[str, dict[bytes, int]]) -> pa.RecordBatch:
        return rows_of([(lang, "word", w.decode(), n) for lang, held in words_of.items() for w, n in held.items()])

    limit = COUNTED_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words_of: dict[str, dict[bytes, int]] = {}
        totals: Counter[str] = Counter()
        long = 0
        for batch in batches:
            for block in blocks(batch):
                data, offsets = utf8(block.column("text"))
                words = Words(data, offsets)
                counts = class_counts(data, offsets)
                langs = np.array(block.column("lang").to_pylist(), object)
                starts, ends = _common_form(words)
                hashes, row = _span_hashes(words), words.row_of()
                raw = data.tobytes()
                for lang in set(langs.tolist()):
                    here = langs == lang
                    classes[lang] = classes.get(lang, 0) + counts[here].sum(axis=0)
                    mine = np.flatnonzero(here[row])
                    totals[lang] += len(mine)
                    _, first, often = np.unique(hashes[mine], return_index=True, return_counts=True)
                    held = words_of.setdefault(lang, {})
                    at = mine[first]
                    for a, b, n in zip(starts[at].tolist(), ends[at].tolist(), often.tolist()):
                        held[raw[a:b]] = held.get(raw[a:b], 0) + n
                        long += max(0, b - a - 64)
                    # Words of usual length are bounded by their number, longer ones by their bytes.
                    if sum(map(len, words_of.values())) > limit or long > COUNTED_BYTES:
                        yield word_rows(words_of)
                        words_of.clear()
                        long = 0
        rows = [(lang, "class", str(k), int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
        rows += [(lang, "all", "", n) for lang, n in totals.items()]
        yield rows_of(rows)
        yield word_rows(words_of)

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = (
        known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(run, "lang string, kind string, name string, n long")
        .groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))
    )
    # Other kinds have fewer names. Each partition of counts sends on its first by rank only.
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= max(COMMON, CLASSES)).drop("rank")


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of ``p`` and of ``q``, both histograms; 0 to 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, class_distance, word_distance and kept.

    Null and empty texts have no words and fail. A distance is null where the text is too short
    for it or no document has a language. Columns of ``docs`` with these names are replaced.
    """
    learned: dict[str, dict] = {}
    for row in references(docs, lang_col, text_col).collect():  # CLASSES + COMMON + 1 rows a language
        learned.setdefault(row["lang"], {"class": {}, "word": {}, "all": {}})[row["kind"]][row["name"]] = row["n"]
    profiles = []
    for lang in sorted(learned):
        one = learned[lang]
        classes = np.array([one["class"].get(str(k), 0) for k in range(CLASSES)], float)
        names = sorted(one["word"])
        often = np.array([one["word"][w] for w in names] + [max(0, one["all"].get("", 0) - sum(one["word"].values()))], float)
        if classes.sum() and often.sum():
            profiles.append((classes / classes.sum(), names, often / often.sum()))
    source = docs.drop(*COLUMNS)
    kept = source.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for classes, names, often in profiles:
            spans = Words(*utf8(pa.array([n + " " for n in names], pa.string())))
            order = np.argsort(spans.hashes())
            tables.append((classes, spans.hashes()[order], np.append(often[:-1][order], often[-1])))
        for batch in batches:
            for block in blocks(batch, text_col):
                yield _judge(block, text_col, kept, tables)

    schema = ", ".join([f"`{n}` {t}" for n, t in source.dtypes] + [
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long",
        "base_failed boolean, class_distance double, word_distance double, kept boolean",
    ])
    return source.mapInArrow(run, schema)


def _repeated_words(words: Words) -> np.ndarray:
    """Words in windows that the same text holds twice or more."""
    at = window_rows(words, REPEAT_WINDOW)
    marks = np.zeros(len(words.starts) + 1, np.int64)
    if len(at):
        row = words.row_of()
        keys = mix(window_hashes(words.hashes(), REPEAT_WINDOW)[at] + mix(row[at].astype(np.uint64) + np.uint64(1)))
        _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[often[which] > 1]
        np.add.at(marks, twice, 1)
        np.add.at(marks, twice + REPEAT_WINDOW, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(marks[:-1]) > 0)])
    return np.diff(total[words.rows])


def _judge(block: pa.RecordBatch, text_col: str, kept: list[str], tables: list) -> pa.RecordBatch:
    data, offsets = utf8(block.column(text_col))
    words = Words(data, offsets)
    classes = class_counts(data, offsets)
    n_words = words.counts
    lines = Words(data, offsets, b"\n")
    has_word = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    keys = np.stack([lines.row_of()[has_word].astype(np.uint64), lines.hashes()[has_word]])
    _, first = np.unique(keys, axis=1, return_index=True)
    dup = np.bincount(lines.row_of()[has_word], minlength=block.num_rows) - np.bincount(lines.row_of()[has_word][first], minlength=block.num_rows)
    repeat = _repeated_words(words)
    failed = (n_words < MIN_KEPT_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)

    class_distance = np.full(block.num_rows, np.nan)
    word_distance = np.full(block.num_rows, np.nan)
    chars = classes.sum(axis=1)
    long_text, long_words = chars >= MIN_CHARS, n_words >= MIN_WORDS
    hashes, row = _span_hashes(words), words.row_of()
    for reference, common, often in tables:
        p = classes[long_text] / chars[long_text][:, None]
        class_distance[long_text] = np.fmin(class_distance[long_text], _distance(p, reference))
        place = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        place = np.where(common[place] == hashes, place, len(common)) if len(common) else np.zeros(len(hashes), int)
        bins = len(often)
        counts = np.bincount(row * bins + place, minlength=block.num_rows * bins).reshape(-1, bins)
        p = counts[long_words] / n_words[long_words][:, None]
        word_distance[long_words] = np.fmin(word_distance[long_words], _distance(p, often))
    odd = (class_distance > MAX_CLASS_DISTANCE) | (word_distance > np.interp(n_words, *MAX_WORD_DISTANCE))
    # fmin and the comparisons leave NaN, too short to tell, on the side of keeping.
    return pa.record_batch({n: block.column(n) for n in kept} | {
        "n_words": pa.array(n_words.astype(np.int64)),
        "word_chars": pa.array(chars - classes[:, 3]),
        "n_symbols": pa.array(classes[:, 5]),
        "n_dup_lines": pa.array(dup.astype(np.int64)),
        "n_repeat_words": pa.array(repeat.astype(np.int64)),
        "base_failed": pa.array(failed),
        "class_distance": pa.array(class_distance, from_pandas=True),
        "word_distance": pa.array(word_distance, from_pandas=True),
        "kept": pa.array(~failed & ~odd),
    })
