"""Repair of conversations whose turns are blank, repeated, cut short or out of order.

A legal conversation's roles are nothing, or user and assistant in turn, with a system row before
them or not. The cheapest edits that make a conversation legal are found by dynamic programming
over four states (nothing yet, after system, after user, after assistant). What a row may do
depends on its role and fault only, so a row is a symbol, and a symbol a min-plus matrix of 4 x 4
costs. Equal symbols in a row are one run; a run of n is passed with the cached powers 1, 2, 4,
... of its matrix. From the costs to the end the choices are then unrolled, the first letter in
ASCII first among the cheapest.

Min-plus products are associative, so a conversation need not be in one task. Rows are dealt in
ranges of (conversation, turn, role, text), so that a long one lies in several partitions. Only the
first and the last conversation of a partition can go on in another one: their matrices, two a
partition, go to the driver, which hands back the costs to the end and the state each piece begins
with. The pieces are unrolled where they are. Equal rows of a turn are merged with a count before
they are moved, and a row's first occurrence is found by an aggregate that is joined back.

Rows are taken by turn (nulls first), then role, then text. A null conversation id is a conversation,
a null role or text one space. Only u, a and s at the beginning of a role are legal; a row of another
role has to be reroled or deleted. Texts that agree in turn, role and their first
``PREFIX`` characters are sorted in one task. Other columns are not read. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from risklake.session import cut_lineage

#: Costs of edits, and of keeping a truncated row. Fixed values.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = r"\x20\x09-\x0D"
STOPS = ".!?"
PREFIX = 256
#: Output rows a worker holds; rows of a run that are unrolled from one vector; rows of a remembered conversation.
AT_ONCE, STRIDE, REMEMBERED = 1000, 256, 64

NEVER = 10**15
STATES = range(4)
#: The state after a role's initial; the state after the next inserted row, and that row's role.
MOVES = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
NEXT = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}
#: Faults of a row; must go, may be kept at a cost, fine.
GOES, CUT, FINE = 0, 1, 2


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(``conv_id:turn``) % 20, as a test
    bed. A dropped row has no copies, and neither turn, role nor text, so that its conversation is still known."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), space), F.coalesce(F.col(turn_col).cast("string"), space))
    told = rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    )
    gone = F.col("kind") == 0
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return told.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{BLANKS}]")


def _is_truncated(text: Column) -> Column:
    last = F.regexp_extract(text, f"([^{BLANKS}])[{BLANKS}]*\\z", 1)
    return ~last.isin(*STOPS)


def ordered(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in order, equal ones of a turn merged, each with its text's fault and whether the
    conversation has the row's role and text in an earlier turn. Stored, since it is read several times."""
    space = F.lit(" ")
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    merged = (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), copies.alias("copies"))
        .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
        .withColumn("digest", F.sha2("text", 256))
    )
    firsts = merged.where("copies > 0").groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")
    ).agg(F.min(F.struct("turn")).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    told = merged.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", "copies",
        F.when(_is_blank(F.col("text")), "blank").when(_is_truncated(F.col("text")), "truncated").otherwise("").alias("fault"),
        F.coalesce(~F.col("turn").eqNullSafe(F.col("_first")["turn"]), F.lit(False)).alias("seen"),
    )
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    ranges = [*keys, F.substring("text", 1, PREFIX).asc()]
    dealt = told.repartitionByRange(partitions, *ranges) if partitions else told.repartitionByRange(*ranges)
    return cut_lineage(dealt.sortWithinPartitions(*keys, F.col("text").asc()))


Symbol = tuple[str, int]
Runs = list[tuple[Symbol, int]]


@lru_cache(maxsize=4096)
def _power(symbol: Symbol, exponent: int) -> tuple[tuple[int, ...], ...]:
    """The costs of 2**``exponent`` rows of a symbol, from state to state; inserts before each row included."""
    if exponent:
        return _times(_power(symbol, exponent - 1), _power(symbol, exponent - 1))
    initial, fault = symbol
    more = TRUNCATED if fault == CUT else 0
    step = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        step[state][state] = DELETE
        if fault != GOES:
            to = MOVES.get(initial, (None,) * 4)[state]
            if to is not None:
                step[state][to] = min(step[state][to], KEEP + more)
            step[state][NEXT[state]] = min(step[state][NEXT[state]], REROLE + more)
    return _times(_INSERTS, tuple(map(tuple, step)))


def _times(a, b):
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def _apply(matrix, vector):
    return tuple(min(NEVER, *(row[k] + vector[k] for k in STATES)) for row in matrix)


#: Costs of inserts alone.
_ONE_INSERT = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else NEVER for j in STATES) for i in STATES)
_INSERTS = _times(_ONE_INSERT, _times(_ONE_INSERT, _ONE_INSERT))
#: Costs from a state to a legal end.
END = _apply(_INSERTS, (0, NEVER, NEVER, 0))
UNIT = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)


def passed(symbol: Symbol, rows: int, vector):
    """Costs to the end before ``rows`` rows of a symbol, from those behind them."""
    exponent = 0
    while rows >> exponent:
        if rows >> exponent & 1:
            vector = _apply(_power(symbol, exponent), vector)
        exponent += 1
    return vector


def product(runs: Runs):
    """The matrix of all runs."""
    total = UNIT
    for symbol, rows in runs:
        for exponent in range(rows.bit_length()):
            if rows >> exponent & 1:
                total = _times(total, _power(symbol, exponent))
    return total


def _choose(symbol: Symbol, state: int, costs, behind) -> tuple[str, int, int]:
    """The first letter in ASCII of a cheapest edit, its cost and the state it leads to. ``costs`` are
    those to the end before the next row, ``behind`` those behind it."""
    here = costs[state]
    initial, fault = symbol
    if DELETE + behind[state] == here:
        return "D", DELETE, state
    if INSERT + costs[NEXT[state]] == here:
        return "I", INSERT, NEXT[state]
    more = TRUNCATED if fault == CUT else 0
    to = MOVES.get(initial, (None,) * 4)[state]
    if fault != GOES and to is not None and KEEP + more + behind[to] == here:
        return "K", KEEP + more, to
    return "R", REROLE + more, NEXT[state]


def unroll(runs: Runs, state: int, end, last: bool) -> tuple[list[tuple[str, int, int]], int]:
    """The edits (letter, cost, state before) from ``state`` on, and the state they end in. ``end`` are the costs
    behind the runs; behind the ``last`` ones missing rows are inserted."""
    vectors = [end]
    for symbol, rows in reversed(runs):
        vectors.append(passed(symbol, rows, vectors[-1]))
    vectors.reverse()
    edits: list[tuple[str, int, int]] = []
    for (symbol, rows), behind in zip(runs, vectors[1:]):
        while rows:
            # Costs behind each of the next rows, from one vector behind all of them.
            n = min(rows, STRIDE)
            rows -= n
            steps = [passed(symbol, rows, behind)]
            for _ in range(n):
                steps.append(_apply(_power(symbol, 0), steps[-1]))
            for k in range(n, 0, -1):
                letter = ""
                while letter in ("", "I"):
                    letter, cost, to = _choose(symbol, state, steps[k], steps[k - 1])
                    edits.append((letter, cost, state))
                    state = to
    while last and state not in (0, 3):
        edits.append(("I", INSERT, state))
        state = NEXT[state]
    return edits, state


@lru_cache(maxsize=20_000)
def _short(runs: tuple) -> list[tuple[str, int, int]]:
    return unroll(list(runs), 0, END, True)[0]


def _whole(runs: Runs) -> list[tuple[str, int, int]]:
    """The edits of a whole conversation; those of few rows are remembered by their symbols."""
    return _short(tuple(runs)) if sum(n for _, n in runs) <= REMEMBERED else unroll(runs, 0, END, True)[0]


def _symbol(role: str, fault: str, first: bool) -> Symbol:
    return (role[:1] if role[:1] in MOVES else "", GOES if fault == "blank" or not first else CUT if fault else FINE)


def _add(runs: Runs, role: str, fault: str, seen: bool, copies: int) -> None:
    """``copies`` rows alike: unless seen before, the first is not a duplicate."""
    for symbol, rows in ((_symbol(role, fault, not seen), min(copies, 1)), (_symbol(role, fault, False), copies - 1)):
        if rows > 0:
            if runs and runs[-1][0] == symbol:
                runs[-1] = (symbol, runs[-1][1] + rows)
            else:
                runs.append((symbol, rows))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict]]]:
    """The rows of one conversation after the other; a conversation's rows follow each other."""
    held, now = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != now:
                yield now, held
                held = []
            now = row["conv_id"]
            held.append(row)
    if held:
        yield now, held


def _runs(rows: list[dict]) -> Runs:
    runs: Runs = []
    for r in rows:
        _add(runs, r["role"], r["fault"], r["seen"], r["copies"])
    return runs


_SYMBOLS = ("conv_id", "role", "fault", "seen", "copies", "turn")


def _id_type(dealt: DataFrame) -> pa.DataType:
    return to_arrow_schema(dealt.select("conv_id").schema).field(0).type


def _borders(dealt: DataFrame) -> list:
    """Two rows a partition at most: matrix, last initial and last turn of its first and last conversation."""
    ids = _id_type(dealt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list = []
        for conv, rows in _groups(batches):
            real = [r for r in rows if r["copies"]]
            turns = [r["turn"] for r in real if r["turn"] is not None]
            matrix = [x for row in product(_runs(rows)) for x in row]
            kept[1:] = [(conv, matrix, real[-1]["role"][:1] if real else None, turns[-1] if turns else None)]
        yield pa.record_batch({
            "part": pa.array([TaskContext.get().partitionId()] * len(kept), pa.int32()),
            "place": pa.array(range(len(kept)), pa.int32()),
            "conv_id": pa.array([k[0] for k in kept], ids),
            "matrix": pa.array([k[1] for k in kept], pa.list_(pa.int64())),
            "initial": pa.array([k[2] for k in kept], pa.string()),
            "turn": pa.array([k[3] for k in kept], pa.int64()),
        })

    schema = f"part int, place int, conv_id {dict(dealt.dtypes)['conv_id']}, matrix array<bigint>, initial string, turn bigint"
    rows = dealt.select(*_SYMBOLS).mapInArrow(run, schema).collect()
    return sorted(rows, key=lambda r: (r["part"], r["place"]))


def _chains(borders: list) -> list[list]:
    """Conversations that lie in several partitions: their pieces in order."""
    chains: list[list] = []
    for row in borders:
        if chains and chains[-1][-1]["conv_id"] == row["conv_id"] and chains[-1][-1]["part"] < row["part"]:
            chains[-1].append(row)
        else:
            chains.append([row])
    return [c for c in chains if len(c) > 1]


def _pieces(dealt: DataFrame) -> dict:
    """(part, conv_id) -> (costs behind the piece, state it begins in, last initial and turn before it, whether it
    is the last), for the pieces of conversations in several partitions."""
    chains = _chains(_borders(dealt))
    if not chains:
        return {}
    behind = {}
    for chain in chains:
        costs = END
        for row in reversed(chain):
            behind[row["part"], row["conv_id"]] = costs
            m = row["matrix"]
            costs = _apply([m[i : i + 4] for i in range(0, 16, 4)], costs)
    shared = dealt.sparkSession.sparkContext.broadcast(behind)
    ids = _id_type(dealt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for conv, rows in _groups(batches):
            costs = shared.value.get((part, conv))
            if costs is not None:
                # A state that no cheapest way begins with may have no way to the end.
                runs = _runs(rows)
                before = _apply(product(runs), costs)
                ends = [unroll(runs, s, costs, False)[1] if before[s] < NEVER else None for s in STATES]
                yield pa.record_batch({"part": pa.array([part], pa.int32()), "conv_id": pa.array([conv], ids), "ends": pa.array([ends], pa.list_(pa.int32()))})

    schema = f"part int, conv_id {dict(dealt.dtypes)['conv_id']}, ends array<int>"
    ends = {(r["part"], r["conv_id"]): r["ends"] for r in dealt.select(*_SYMBOLS).mapInArrow(run, schema).collect()}
    out = {}
    for chain in chains:
        state, initial, turn = 0, None, None
        for row in chain:
            key = row["part"], row["conv_id"]
            out[key] = behind[key], state, initial, turn, row is chain[-1]
            state = ends[key][state]
            initial = row["initial"] if row["initial"] is not None else initial
            turn = row["turn"] if row["turn"] is not None else turn
    return out


_EDIT = pa.schema([
    ("turn", pa.int64()), ("edit", pa.string()), ("cost", pa.int64()), ("fault", pa.string()), ("illegal", pa.bool_()),
    ("new_turn", pa.bool_()), ("role", pa.string()), ("text", pa.string()),
])


def _edits(rows: list[dict], edits: Iterator[tuple[str, int, int]], initial: str | None, turn: int | None) -> Iterator[tuple]:
    """One row of ``_EDIT`` an edit, and one without a letter for what has no copies."""
    for r in rows:
        if not r["copies"]:
            yield None, "", 0, "", False, False, None, None
        for copy in range(r["copies"]):
            letter, cost, state = next(edits)
            while letter == "I":
                yield None, "I", cost, "", False, False, ROLES[state], ""
                letter, cost, state = next(edits)
            fault = "duplicate" if r["fault"] != "blank" and (copy or r["seen"]) else r["fault"]
            role = None if letter == "D" else ROLES[state] if letter == "R" else r["role"]
            illegal = initial is not None and initial + r["role"][:1] not in LEGAL
            yield r["turn"], letter, cost, fault, illegal, r["turn"] is not None and r["turn"] != turn, role, None if letter == "D" else r["text"]
            initial, turn = r["role"][:1], r["turn"] if r["turn"] is not None else turn
    for letter, cost, state in edits:
        yield None, letter, cost, "", False, False, ROLES[state], ""


def repair(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """The cheapest edits of all conversations of ``rows`` (conv_id, turn, role, text, and maybe ``copies``), a
    row each:

    conv_id, part, place  its conversation, and the order in it
    turn, fault           of the row that it is about: blank, duplicate, truncated or empty
    edit, cost            D, I, K or R; an empty edit only tells that the conversation exists
    role, text            of the repaired row, null when it is deleted
    illegal               whether the row may not follow the one before it
    new_turn              whether the row's turn is another than that before it; false for null

    ``partitions`` fixes the number of ranges.
    """
    dealt = ordered(rows, partitions)
    ids = _id_type(dealt)
    shared = dealt.sparkSession.sparkContext.broadcast(_pieces(dealt))  # two pieces a partition at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held))
            told = {"conv_id": pa.array(columns[0], ids), "part": pa.array([part] * len(held), pa.int32()), "place": pa.array(columns[1], pa.int64())}
            told |= {f.name: pa.array(c, f.type) for f, c in zip(_EDIT, columns[2:])}
            held.clear()
            return pa.record_batch(told)

        for conv, group in _groups(batches):
            known = shared.value.get((part, conv))
            if known is None:
                edits, initial, turn = _whole(_runs(group)), None, None
            else:
                costs, state, initial, turn, last = known
                edits, _ = unroll(_runs(group), state, costs, last)
            for place, row in enumerate(_edits(group, iter(edits), initial, turn)):
                held.append((conv, place, *row))
                if len(held) >= AT_ONCE:
                    yield flush()
        if held:
            yield flush()

    kinds = "part int, place bigint, turn bigint, edit string, cost bigint, fault string, illegal boolean, new_turn boolean, role string, text string"
    return dealt.select(*_SYMBOLS, "text").mapInArrow(run, f"conv_id {dict(dealt.dtypes)['conv_id']}, {kinds}")


def summarize(edits: DataFrame) -> DataFrame:
    """One row a conversation: gaps, faults, illegal, cost, audit, and ``repaired``, its messages as role:text in order."""
    count = lambda said: F.count_if(said).alias
    wide = F.col("turn").cast("decimal(20,0)")
    gaps = F.max(wide) - F.min(wide) + 1 - F.count_if(F.col("new_turn"))
    message = F.when(F.col("role").isNotNull(), F.concat("role", F.lit(":"), "text"))
    return edits.groupBy("conv_id").agg(
        F.least(F.coalesce(gaps, F.lit(0)), F.lit(2**63 - 1)).cast("long").alias("gaps"),
        count(F.col("fault") == "blank")("blank"),
        count(F.col("fault") == "duplicate")("duplicate"),
        count(F.col("fault") == "truncated")("truncated"),
        count(F.col("illegal"))("illegal"),
        F.sum("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("part", "place", "edit", message.alias("message")))).alias("said"),
    ).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.col("said.edit"), "").alias("audit"),
        F.array_compact(F.col("said.message")).alias("repaired"),
    )
