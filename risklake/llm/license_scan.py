"""Licence scans by template-markup matching.

A template is a licence's wording with optional and replaceable regions (license_templates.py).
It is compiled into an automaton over word tokens: one place per mandatory word or word of a
region, and for every place the places that may follow. A span of a text is accepted when its
words lead from a first place to a last one, so the mandatory wording has to match word for
word. Optional regions at either end of a template are tried like the others; the longest
accepted span from each first word counts.

All templates share one automaton, whose sets of places are turned into states as they are met
(a worker keeps ``KEPT_STEPS`` steps, then forgets them all, which changes no result). It runs
only from words that can open a template, and a run ends with the automaton's last live place, at
the longest template's length at the latest: the work grows with the words.

Words are compared by two 64-bit hashes. One row of a text never meets another: nothing is
shuffled, and memory is bounded by a block of text. A null or empty text has no words and
no spans; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from risklake.llm.license_templates import PHRASES, TEMPLATES
from risklake.llm.words import Words, blocks, lower_ascii, utf8

#: Bytes between words: all of ASCII but digits and letters (of lower-cased text). A fixed value.
BETWEEN = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
#: Stands for any word; a text's token of no template is UNKNOWN.
ANY, UNKNOWN = -1, 0
KEPT_STEPS = 200_000
#: Scores of a text with an accepted template, and of one with a phrase only.
ACCEPTED, MENTIONED = 1.0, 0.5

_MARK = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def parse(template: str) -> tuple:
    """A template as nested parts: ("word", w), ("any", least, most), ("either", [words, ...])
    and ("optional", parts)."""
    stack: list[list] = [[]]
    at = 0
    for mark in [*_MARK.finditer(template), None]:
        stack[-1] += [("word", w) for w in words_of(template[at : mark.start() if mark else None])]
        if mark is None:
            break
        at, said = mark.end(), mark.group(1)
        if said == "beginOptional":
            stack.append([])
        elif said == "endOptional" and len(stack) > 1:
            inside = tuple(stack.pop())
            stack[-1].append(("optional", inside))
        elif (spread := re.fullmatch(r"var;words=(\d+)-(\d+)", said)) and int(spread[1]) <= int(spread[2]):
            stack[-1].append(("any", int(spread[1]), int(spread[2])))
        elif said.startswith("var;match="):
            stack[-1].append(("either", tuple(tuple(words_of(x)) for x in said[10:].split("|"))))
        else:
            raise ValueError(f"unknown markup <<{said}>>")
    if len(stack) > 1:
        raise ValueError("an optional region isn't closed")
    return tuple(stack[0])


class Automaton:
    """All templates in one automaton over word tokens."""

    def __init__(self, templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...] = ()):
        self.tokens: dict[str, int] = {}
        self.labels = [label for label, _ in templates]
        self.wanted: list[int] = []
        self.follow: list[set[int]] = []
        self.ends: dict[int, int] = {}
        first: set[int] = set()
        for number, (_, template) in enumerate(templates):
            opening, last, skippable = self._sequence(parse(template))
            if skippable or not last:
                raise ValueError(f"template {number} has no mandatory word")
            if any(self.wanted[p] == ANY for p in opening):
                raise ValueError(f"template {number} opens with a region of any words")
            first |= opening
            self.ends |= dict.fromkeys(last, number)
        self.phrases = [([self._token(w) for w in words_of(p)], label) for p, label in phrases]
        self.first = frozenset(first)
        self.openers = np.array(sorted({self.wanted[p] for p in first}), np.int64)
        self._forget()

    def _token(self, word: str) -> int:
        return self.tokens.setdefault(word, len(self.tokens) + 1)

    def _place(self, token: int) -> int:
        self.wanted.append(token)
        self.follow.append(set())
        return len(self.wanted) - 1

    def _sequence(self, parts) -> tuple[set[int], set[int], bool]:
        """Adds places for ``parts`` in a row: those it may begin and end with, and whether it
        may be empty."""
        first: set[int] = set()
        last: set[int] = set()
        empty = True
        for part in parts:
            a, b, skippable = self._part(part)
            for p in last:
                self.follow[p] |= a
            first = first | a if empty else first
            last = last | b if skippable else b
            empty = empty and skippable
        return first, last, empty

    def _part(self, part) -> tuple[set[int], set[int], bool]:
        if part[0] == "word":
            p = self._place(self._token(part[1]))
            return {p}, {p}, False
        if part[0] == "optional":
            a, b, _ = self._sequence(part[1])
            return a, b, True
        if part[0] == "any":
            run = [self._place(ANY) for _ in range(part[2])]
            for p, q in zip(run, run[1:]):
                self.follow[p].add(q)
            return set(run[:1]), set(run[max(part[1], 1) - 1 :]), part[1] == 0
        found = [self._sequence([("word", w) for w in words]) for words in part[1]]
        return set().union(*(f[0] for f in found)), set().union(*(f[1] for f in found)), any(f[2] for f in found)

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.accepts: list[tuple[int, ...]] = []
        self.steps: dict[tuple[int, int], int] = {}

    def _state(self, places: frozenset) -> int:
        state = self.states.get(places)
        if state is None:
            state = self.states[places] = len(self.sets)
            self.sets.append(places)
            self.accepts.append(tuple(sorted({self.ends[p] for p in places if p in self.ends})))
        return state

    def spans(self, tokens: list[int], start: int) -> dict[int, int]:
        """Template -> end of its longest span that begins at word ``start``, where there is one."""
        if len(self.steps) > KEPT_STEPS:
            self._forget()
        wanted, found = self.wanted, {}
        state, at = -1, start
        while at < len(tokens):
            token = tokens[at]
            after = self.steps.get((state, token))
            if after is None:
                may = self.first if state < 0 else frozenset().union(*(self.follow[p] for p in self.sets[state]))
                places = frozenset(p for p in may if wanted[p] == token or wanted[p] == ANY)
                after = self.steps[state, token] = self._state(places)
            state, at = after, at + 1
            for number in self.accepts[state]:
                found[number] = at
            if not self.sets[state]:
                break
        return found


@lru_cache(maxsize=4)
def _compiled(templates, phrases) -> tuple[Automaton, np.ndarray, np.ndarray, np.ndarray]:
    """The automaton, and its words' hashes in order, with second hashes and tokens."""
    automaton = Automaton(templates, phrases)
    column = pa.array(list(automaton.tokens), pa.large_string())
    words = Words(*utf8(column), BETWEEN)
    one, two = words.hashes(0), words.hashes(1)
    order = np.argsort(one)
    return automaton, one[order], two[order], np.array(list(automaton.tokens.values()))[order]


def _tokens(words: Words, one: np.ndarray, two: np.ndarray, names: np.ndarray) -> np.ndarray:
    mine = words.hashes(0)
    spot = np.minimum(np.searchsorted(one, mine), len(one) - 1)
    known = np.flatnonzero(one[spot] == mine)
    out = np.full(len(mine), UNKNOWN)
    if len(known):
        sure = known[two[spot[known]] == words.hashes(1)[known]]
        out[sure] = names[spot[sure]]
    return out


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """All rows and columns of ``docs``, with

    n_words        words of the whole text, A-Z lower-cased
    phrases        places of phrases: (label, start), in order of start
    spans          accepted spans: (label, start, stop), words from 0, in order of start
    score          1 with a span, 0.5 with places of phrases only, else 0

    Columns so named are replaced.
    """
    mine = ("n_words", "phrases", "spans", "score")
    source = docs.drop(*mine)
    kept = source.columns
    place, span = pa.struct([("label", pa.string()), ("start", pa.int64())]), pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, *table = _compiled(templates, phrases)
        for batch in batches:
            for block in blocks(batch, text_col):
                data, offsets = utf8(block.column(text_col))
                words = Words(lower_ascii(data), offsets, BETWEEN)
                tokens = _tokens(words, *table)
                said: list[list] = [[] for _ in range(block.num_rows)]
                held: list[list] = [[] for _ in range(block.num_rows)]
                row = words.row_of()
                for sequence, label in automaton.phrases:
                    n = len(tokens) - len(sequence) + 1
                    if n > 0:
                        same = row[:n] == row[len(sequence) - 1 :]
                        for i, token in enumerate(sequence):
                            same &= tokens[i : n + i] == token
                        for at in np.flatnonzero(same).tolist():
                            said[row[at]].append({"label": label, "start": at - int(words.rows[row[at]])})
                starts = np.flatnonzero(np.isin(tokens, automaton.openers))
                for r in np.unique(row[starts]).tolist():
                    low, high = int(words.rows[r]), int(words.rows[r + 1])
                    text = tokens[low:high].tolist()
                    for at in starts[np.searchsorted(starts, low) : np.searchsorted(starts, high)].tolist():
                        for number, stop in sorted(automaton.spans(text, at - low).items()):
                            held[r].append({"label": automaton.labels[number], "start": at - low, "stop": stop})
                score = [ACCEPTED if h else MENTIONED if s else 0.0 for h, s in zip(held, said)]
                yield pa.record_batch({c: block.column(c) for c in kept} | {
                    "n_words": pa.array(words.counts, pa.int64()),
                    "phrases": pa.array([sorted(s, key=lambda x: (x["start"], x["label"])) for s in said], pa.list_(place)),
                    "spans": pa.array(held, pa.list_(span)),
                    "score": pa.array(score, pa.float64()),
                })

    schema = ", ".join([f"`{n}` {t}" for n, t in source.dtypes] + [
        "n_words bigint, phrases array<struct<label:string,start:bigint>>, spans array<struct<label:string,start:bigint,stop:bigint>>, score double",
    ])
    return source.mapInArrow(run, schema)
