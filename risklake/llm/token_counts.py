"""Token counts of whole texts, by a map-side lookup in two tiers.

A byte-level tokenizer cuts a text into pre-tokens and encodes each on its own, so a count is
a sum of pre-token lengths. Tier one is a compact table of the corpus' frequent pre-tokens and
their lengths, broadcast once; it has ``TABLE_SIZE`` entries at most, whatever the input. Tier
two is each worker's bounded memory; what is in neither is encoded by the tokenizer. No text
and no pre-token is shuffled: only each task's most frequent words are, ``TASK_WORDS`` at most,
to fill the table, which changes the speed and never a count.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from risklake.llm.pretokens import Memory, Pretokens
from risklake.llm.words import Words, blocks, utf8

TABLE_SIZE = 32_768
TASK_WORDS = 4_096
#: Words counted at once in a task; the rarer half is dropped when there are more.
COUNTED_WORDS = 200_000
#: Longer words aren't frequent, and would make the table large.
LONGEST_WORD = 64
TOKEN_LIMIT = 512


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, regex.Pattern | None]:
    """The tokenizer, and a pattern of the added tokens that it finds inside texts."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    before = said.get("pre_tokenizer") or {}
    if said.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        raise ValueError(f"{path}: only byte-level tokenizers without normalizer encode pre-tokens one by one")
    added = sorted((x["content"] for x in said.get("added_tokens", [])), key=len, reverse=True)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, regex.compile("|".join(map(regex.escape, added))) if added else None


def _lengths(tokenizer: Tokenizer, pretokens: list[bytes]) -> list[int]:
    """Token counts of pre-tokens; a task has one core, so the library gets no threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = tokenizer.encode_batch_fast([p.decode() for p in pretokens], add_special_tokens=False)
    return [len(x) for x in found]


def frequent_words(texts: DataFrame) -> DataFrame:
    """(word, n): frequent words of all texts, from every task's most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for block in blocks(batch):
                words = Words(*utf8(block.column("text")))
                _, first, often = np.unique(words.hashes(), return_index=True, return_counts=True)
                data = words.data.tobytes()
                for a, b, n in zip(words.starts[first].tolist(), words.ends[first].tolist(), often.tolist()):
                    if b - a <= LONGEST_WORD:
                        counts[data[a:b]] = counts.get(data[a:b], 0) + n
                if len(counts) > COUNTED_WORDS:
                    counts = dict(Counter(counts).most_common(COUNTED_WORDS // 2))
        top = Counter(counts).most_common(TASK_WORDS)
        yield pa.record_batch({
            "word": pa.array([w for w, _ in top], pa.binary()).cast(pa.string()),
            "n": pa.array([n for _, n in top], pa.int64()),
        })

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def length_table(texts: DataFrame, path: str) -> dict[bytes, int]:
    """Token counts of the pre-tokens in the most frequent words."""
    tokenizer, _ = _tokenizer(path)
    top = frequent_words(texts).orderBy(F.desc("n"), "word").limit(TABLE_SIZE // 2).collect()
    # A word stands behind a blank or at the start of a line.
    both = pa.array([form for row in top for form in (" " + row["word"], row["word"])], pa.string())
    pieces, _ = Pretokens(*utf8(both)).distinct()
    pieces = pieces[:TABLE_SIZE]
    return dict(zip(pieces, _lengths(tokenizer, pieces)))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Counts are those of ``tokenizers`` without added begin, end, padding or truncation; added
    tokens that stand in a text are one token each, as is the library's default. A null text
    counts as empty. Ids may be null or repeat; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = length_table(texts.select("text"), path)
    compact = b"".join(table), tuple(map(len, table)), tuple(table.values())
    shared = docs.sparkSession.sparkContext.broadcast(compact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, added = _tokenizer(path)
        memory = _memory(path, *shared.value)
        for batch in batches:
            for block in blocks(batch):
                data, offsets = utf8(block.column("text"))
                cut = Pretokens(data, offsets, added)
                pieces, which = cut.distinct()
                total = np.zeros(len(which) + 1, np.int64)
                np.cumsum(np.array(memory.values(pieces), np.int64)[which], out=total[1:])
                tokens = np.diff(total[cut.rows])
                yield pa.record_batch({
                    "id": block.column("id"),
                    "n_bytes": pa.array(np.diff(offsets)),
                    "n_tokens": pa.array(tokens),
                    "over_limit": pa.array(tokens > TOKEN_LIMIT),
                })

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    ).withColumnRenamed("id", id_col)


@lru_cache(maxsize=1)
def _memory(path: str, pretokens: bytes, sizes: tuple[int, ...], lengths: tuple[int, ...]) -> Memory:
    """The broadcast table as tier one of a worker's memory; built once in a worker."""
    tokenizer, _ = _tokenizer(path)
    ends = np.cumsum(sizes).tolist()
    fixed = {pretokens[end - size : end]: n for end, size, n in zip(ends, sizes, lengths)}
    return Memory(lambda pieces: _lengths(tokenizer, pieces), fixed)
