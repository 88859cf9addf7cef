"""Removal of long word passages that an earlier document holds too.

A window is ``MIN_WORDS`` consecutive words. A word goes when a window over it also starts in
a document with a smaller id. All windows are judged on the input.

Shards are by content, so no document meets every index. The least hash of the
``ANCHOR_WORDS``-word groups in a window is its anchor; equal windows have equal anchors.
Consecutive windows of one anchor make a segment. Anchors of one document alone end here.
Equal segments are merged to one with the smallest document; later holders lose all of its
windows. The distinct segments of one anchor go to one shard, where a compressed FM-index is built
over them and every segment is streamed through it: backward search gives matching statistics
against smaller documents, and stretches of at least ``MIN_WORDS`` words are reported. They are then
joined with all places of their segment.

An anchor with more than ``GROUP_SEGMENTS`` distinct segments (a passage in very many documents, at
whose edges all differ) would fill a shard. Its segments are cut by a finer anchor, which equal windows share
as well: the least hashes of the first and of the last few groups, ever fewer of them, as the words
at an edge show in these; in the end the whole window. What is cut is settled like any other segments, so
rows are made of what may still be shared only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.fm_index import FMIndex
from risklake.llm.words import Words, blocks, mix, utf8, window_hashes, window_rows
from risklake.session import cut_lineage

MIN_WORDS = 50
ANCHOR_WORDS = 10
#: A segment has so many windows at most; longer runs of one anchor are cut.
SEGMENT_WINDOWS = 64
#: More distinct segments of one anchor than this are cut by a finer anchor.
GROUP_SEGMENTS = 512
#: How many groups at either end of a window make its finer anchors; 0 stands for the whole window.
FINER = (16, 4, 1, 0)
#: The columns that ``remove_repeats`` adds.
COLUMNS = ("n_words", "n_removed", "kept_text")
#: An index is built over whole anchors with about so many words.
SHARD_WORDS = 150_000


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def segments(docs: DataFrame) -> DataFrame:
    """(id, key, pos, windows, anchor, hash) of every segment; docs are (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                words = Words(*utf8(block.column("text")))
                at = window_rows(words, MIN_WORDS)
                if not len(at):
                    continue
                hashes = words.hashes()
                anchors = _least_of(window_hashes(hashes, ANCHOR_WORDS), MIN_WORDS - ANCHOR_WORDS + 1)[at]
                new = np.ones(len(at), bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (at[1:] != at[:-1] + 1)
                first = np.flatnonzero(new)
                run_of = np.cumsum(new) - 1
                new |= (np.arange(len(at)) - first[run_of]) % SEGMENT_WINDOWS == 0
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(at)))
                begin = at[first]
                whole = _spans_hash(words.hashes(1), begin, count + MIN_WORDS - 1)
                row = np.searchsorted(words.rows, begin, "right") - 1
                yield pa.record_batch({
                    "id": block.column("id").take(pa.array(row)),
                    "key": block.column("key").take(pa.array(row)),
                    "pos": pa.array((begin - words.rows[row]).astype(np.int32)),
                    "windows": pa.array(count.astype(np.int32)),
                    "anchor": pa.array(_signed(anchors[first])),
                    "hash": pa.array(_signed(whole)),
                })

    return docs.mapInArrow(run, "id long, key long, pos int, windows int, anchor long, hash long")


def _spans_hash(words: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of spans of different lengths."""
    out = np.empty(len(begin), np.uint64)
    for size in np.unique(length):
        here = length == size
        out[here] = window_hashes(words, int(size), 1)[begin[here]]
    return out


_IDENTITY = ("anchor", "hash", "windows")
_SEGMENT = "anchor long, hash long, windows int, id long, many boolean, words array<long>"


def _lists(begin: np.ndarray, length: np.ndarray, words: np.ndarray) -> pa.ListArray:
    """Spans of ``words``, a list each."""
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(_signed(words[np.repeat(begin, length) + inner]))
    )


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of wanted segments as 64-bit hashes, in the columns of ``_SEGMENT``. Wanted are (anchor, hash,
    windows, many, owner), the owner being the place (id, key, pos) that they are read from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                words = Words(*utf8(block.column("text")))
                lists = block.column("wanted")
                row = np.repeat(np.arange(block.num_rows), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                pos, count = (flat.field(k).to_numpy() for k in ("pos", "windows"))
                yield pa.record_batch({
                    **{c: flat.field(c) for c in _IDENTITY},
                    "id": block.column("id").take(pa.array(row)),
                    "many": flat.field("many"),
                    "words": _lists(words.rows[row] + pos, count + MIN_WORDS - 1, words.hashes()),
                })

    per_doc = wanted.groupBy(F.col("owner.id").alias("id"), F.col("owner.key").alias("key")).agg(
        F.collect_list(F.struct("owner.pos", *_IDENTITY, "many")).alias("wanted")
    )
    return docs.join(per_doc, ["id", "key"]).mapInArrow(run, _SEGMENT)


def _search(fetched: DataFrame) -> DataFrame:
    """(anchor, hash, windows, id, start, stop): stretches of words of a segment that segments of smaller documents
    hold too, found through one FM-index per shard."""

    def shard(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        lists = table.column("words").combine_chunks()
        length = np.diff(lists.offsets.to_numpy())
        ids = table.column("id").to_numpy()
        index = FMIndex(lists.flatten().to_numpy(), length, np.unique(ids, return_inverse=True)[1])
        found = index.shared_windows(MIN_WORDS)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], found, [False]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        row = np.searchsorted(index.starts, first, "right") - 1
        of = table.select([*_IDENTITY, "id"]).take(pa.array(row)).combine_chunks()
        start = first - index.starts[row]
        return pa.record_batch({
            **{c: of.column(c).combine_chunks() for c in (*_IDENTITY, "id")},
            "start": pa.array(start.astype(np.int32)),
            "stop": pa.array((start + (last - first) + MIN_WORDS - 1).astype(np.int32)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            if not len(anchors):
                continue
            new = np.ones(len(anchors), bool)
            new[0] = anchors[0] != last
            new[1:] = anchors[1:] != anchors[:-1]
            starts = np.flatnonzero(new)
            words = batch.column("words").offsets.to_numpy()
            done = 0
            for start in starts:  # whole anchors only: a shard ends where an anchor begins
                if size + words[start] - words[done] >= SHARD_WORDS:
                    held.append(batch.slice(done, start - done))
                    yield shard(held)
                    held, size, done = [], 0, start
            held.append(batch.slice(done))
            size += words[-1] - words[done]
            last = anchors[-1]
        if held:
            yield shard(held)

    sorted_rows = fetched.repartition("anchor").sortWithinPartitions("anchor")
    return sorted_rows.mapInArrow(run, "anchor long, hash long, windows int, id long, start int, stop int")


def _cut(fetched: DataFrame, level: int) -> DataFrame:
    """Segments of a finer anchor, with their words and, as p_anchor, p_hash and p_windows, what they are cut from;
    ``pos`` counts from there."""
    groups, ends = MIN_WORDS - ANCHOR_WORDS + 1, FINER[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("words")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            words = lists.flatten().to_numpy().view(np.uint64)
            count = batch.column("windows").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), count)
            at = offsets[:-1][row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            anchors = batch.column("anchor").to_numpy().view(np.uint64)[row]
            with np.errstate(over="ignore"):
                if ends:
                    least = _least_of(window_hashes(words, ANCHOR_WORDS), ends)
                    finer = mix(mix(anchors + least[at]) + least[at + groups - ends])
                else:
                    finer = mix(anchors + window_hashes(words, MIN_WORDS)[at])
            new = np.ones(len(at), bool)
            new[1:] = (finer[1:] != finer[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            windows = np.diff(np.append(first, len(at)))
            begin, of = at[first], row[first]
            yield pa.record_batch({
                **{f"p_{c}": batch.column(c).take(pa.array(of)) for c in _IDENTITY},
                "id": batch.column("id").take(pa.array(of)),
                "pos": pa.array((begin - offsets[:-1][of]).astype(np.int32)),
                "windows": pa.array(windows.astype(np.int32)),
                "anchor": pa.array(_signed(finer[first])),
                "hash": pa.array(_signed(_spans_hash(words, begin, windows + MIN_WORDS - 1))),
                "words": _lists(begin, windows + MIN_WORDS - 1, words),
            })

    return fetched.mapInArrow(
        run, "p_anchor long, p_hash long, p_windows int, id long, pos int, windows int, anchor long, hash long, words array<long>"
    )


def _settle(found: DataFrame, place: tuple[str, ...], fetch, level: int = 0) -> DataFrame:
    """(id, the columns of ``place``, pos, stop) of the stretches that smaller documents hold too. ``found`` are
    segments; ``fetch`` gives the distinct ones of them that are wanted with their words."""
    anchors = found.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    shared = cut_lineage(found.join(anchors.where("least < most").select("anchor"), "anchor"))
    more = [F.any_value("words").alias("words")] if "words" in found.columns else []
    distinct = shared.groupBy(*_IDENTITY).agg(F.min(F.struct("id", *place, "pos")).alias("owner"), *more)
    later = shared.join(distinct.select(*_IDENTITY, "owner"), [*_IDENTITY]).where(F.col("id") > F.col("owner.id"))
    whole = later.select("id", *place, "pos", (F.col("pos") + F.col("windows") + MIN_WORDS - 1).alias("stop"))
    groups = distinct.groupBy("anchor").agg((F.count("*") > GROUP_SEGMENTS).alias("many"), F.count("*").alias("group"))
    wanted = distinct.join(groups.where("group > 1").drop("group"), "anchor")
    fetched = cut_lineage(fetch(wanted))
    stretches = _search(fetched.where("NOT many"))
    crowded = fetched.where("many")
    if level < len(FINER) and not crowded.isEmpty():
        own = lambda w: w.select(*_IDENTITY, F.col("owner.id").alias("id"), "many", "words")
        # Read twice, to find what is shared and to take it.
        pieces = cut_lineage(_cut(crowded, level))
        finer = _settle(pieces, ("p_anchor", "p_hash", "p_windows"), own, level + 1)
        names = {f"p_{c}": c for c in _IDENTITY} | {"pos": "start"}
        stretches = stretches.unionByName(finer.withColumnsRenamed(names))
    # Later holders of a segment lose it whole; of its smallest document every place counts.
    inside = shared.join(stretches, [*_IDENTITY, "id"]).select(
        "id", *place, (F.col("pos") + F.col("start")).alias("pos"), (F.col("pos") + F.col("stop")).alias("stop")
    )
    return whole.unionByName(inside)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, key, pos, stop) of word stretches that smaller documents hold; docs are (id, key, text)."""
    known = docs.where("id IS NOT NULL AND text IS NOT NULL")
    return _settle(segments(known), ("key",), lambda wanted: _fetch(known, wanted))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with ``n_words``, ``n_removed`` and ``kept_text``.

    ``kept_text`` joins the kept words by one space. A null text has no words and gives "".
    Rows with a null id are kept whole and make no other row lose anything. Rows of one id are
    parts of one document: they don't remove each other's words. Columns of ``docs`` named as
    the new ones are replaced.
    """
    rest = docs.drop(*COLUMNS)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    spans = repeated_spans(keyed).groupBy("id", "key").agg(F.collect_set(F.struct("pos", "stop")).alias("_spans"))
    names = {n: f"_c{i}" for i, n in enumerate(rest.columns)}
    plain = rest.select(*[F.col(f"`{n}`").alias(c) for n, c in names.items()])
    text, key = names[text_col], F.xxhash64(names[text_col])
    joined = (
        plain.withColumns({"_id": F.col(names[id_col]).cast("long"), "_key": key})
        .join(spans.withColumnsRenamed({"id": "_id", "key": "_key"}), ["_id", "_key"], "left")
        .drop("_id", "_key")
    )
    schema = [f"{c} {t}" for c, t in plain.dtypes] + ["n_words long", "n_removed long", "kept_text string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                words = Words(*utf8(block.column(text)))
                lists = block.column("_spans")
                owner = np.repeat(np.arange(block.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                flat = lists.flatten()
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, words.rows[owner] + flat.field("pos").to_numpy(), 1)
                np.add.at(change, words.rows[owner] + flat.field("stop").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                keep = ~gone
                # Every kept word and one space behind it, cut out of the bytes in one go.
                size = (words.ends - words.starts + 1)[keep]
                at = np.repeat(words.starts[keep], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                last = np.cumsum(size) - 1
                out = np.append(words.data, np.uint8(32))[at]
                out[last] = 32
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(keep)])[words.rows]]
                parts = [out[a : b - 1].tobytes() if b > a else b"" for a, b in zip(ends[:-1], ends[1:])]
                removed = np.concatenate([[0], np.cumsum(gone)])[words.rows]
                columns = {c: block.column(c) for c in names.values()}
                columns |= {
                    "n_words": pa.array(words.counts.astype(np.int64)),
                    "n_removed": pa.array(np.diff(removed).astype(np.int64)),
                    "kept_text": pa.array(parts, pa.binary()).cast(pa.string()),
                }
                yield pa.record_batch(columns)

    back = {c: n for n, c in names.items()}
    return joined.mapInArrow(run, ", ".join(schema)).withColumnsRenamed(back)
