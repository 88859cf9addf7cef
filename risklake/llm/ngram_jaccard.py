"""Similarity classes of texts by the Jaccard similarity of their word shingles, exactly.

A text's set holds its distinct ``SHINGLE`` -word shingles, with A-Z lower-cased; a shorter
text is one shingle. Texts link when their sets' similarity is ``PERCENT`` or more.

1. Equal sets are one node, merged before any shuffle. Nodes without enough shingles that any
   other node has can't link. They are sorted out twice: on the ``SKETCH`` smallest hashes of
   each set (two sets of similarity 0.8 have fewer than ``SKETCH_SHARED`` of 64 in common with a
   probability under 1e-15, as rare as a clash of hashes), then on the whole sets of the rest.
2. Nodes are put into groups: each joins the node that leads most of its rare shingles, where
   the rarest shingles of a node are those of which one must be shared by any partner.
3. A first look links nodes to their group's leader; what it links is one component.
4. The token-group matrix: a group is cut into blocks; a block keeps its members' token union.
   A node of another component is looked up in the blocks of its own group and of every group
   that holds one of its rare shingles as an index shingle. Those are fewer: of a pair the larger node asks,
   and the smaller one shares 8/9 of its set or more, not only 4/5. Its overlap with the union bounds its overlap with any
   member; only blocks that qualify are opened, and every member in them is compared.
5. Components of all links give the class.

Pairs that are already in one component aren't compared, so a group of near copies costs its
size, not its square; nodes that stay outside of it meet it block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.components import connected_components
from risklake.llm.words import Words, blocks, lower_ascii, mix, utf8, window_hashes
from risklake.session import cut_lineage

SHINGLE = 5
PERCENT = 80
SKETCH = 64
SKETCH_SHARED = 21
#: Up to this size a set and all its possible partners are sketched whole.
SKETCH_WHOLE = SKETCH * PERCENT // 100
#: Members of a block, and nodes looked up in it at a time, have about so many tokens.
BLOCK_TOKENS = 100_000
#: Up to so many ids of 8 bytes are broadcast.
BROADCAST_IDS = 2_000_000
#: Columns of the incidence matrix held at once when a block is opened.
OPEN_COLUMNS = 4096
#: Nodes looked up, and members, that are compared at once when a block is opened.
OPEN_ROWS = 1024


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.uint64).view(np.int64)))


def _sets(block: pa.RecordBatch) -> list[np.ndarray]:
    data, offsets = utf8(block.column("text"))
    words = Words(lower_ascii(data), offsets)
    hashes = words.hashes()
    shingles = window_hashes(hashes, SHINGLE)
    out = []
    for first, count in zip(words.rows[:-1], words.counts):
        if count >= SHINGLE:
            out.append(np.unique(shingles[first : first + count - SHINGLE + 1]))
        elif count:
            out.append(window_hashes(hashes[first : first + count], int(count)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(id, n, h0, h1, sketch): size of the set, its 128-bit hash and its smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = [np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)]
        for batch in batches:
            for block in blocks(batch):
                sets = _sets(block)
                with np.errstate(over="ignore"):
                    sums = [np.array([mix(s ^ salt).sum() for s in sets], np.uint64).view(np.int64) for salt in salts]
                yield pa.record_batch({
                    "id": block.column("id"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "h0": pa.array(sums[0]),
                    "h1": pa.array(sums[1]),
                    "sketch": _lists([s[:SKETCH] for s in sets]),
                })

    return docs.mapInArrow(run, "id long, n long, h0 long, h1 long, sketch array<long>")


def _whole_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                sets = _sets(block)
                yield pa.record_batch({
                    "node": block.column("id"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "tokens": _lists(sets),
                })

    return docs.mapInArrow(run, "node long, n long, tokens array<long>")


def _need(n: str = "n"):
    """The least overlap with any partner: PERCENT of the set, rounded up."""
    return F.ceil(F.col(n) * PERCENT / 100)


def _need_of_larger(n: str = "n"):
    """The least overlap with a partner that is as large or larger."""
    return F.ceil(F.col(n) * 2 * PERCENT / (100 + PERCENT))


def _with_shared_tokens(nodes: DataFrame, tokens: str) -> DataFrame:
    """(node, n, shared): the tokens that other nodes have too, rarest first."""
    each = nodes.select("node", "n", F.explode(tokens).alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    return each.join(often, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("holders", "token"))).alias("shared")
    )


def _candidates(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, tokens) of the nodes that can have a partner by their sketches."""
    enough = F.when(F.col("n") <= SKETCH_WHOLE, _need()).otherwise(SKETCH_SHARED)
    likely = _with_shared_tokens(nodes, "sketch").where(F.size("shared") >= enough).select(F.col("node").alias("id"))
    # Few documents come this far. Their ids go to the texts while these are read, if they fit;
    # otherwise texts and ids are joined by a shuffle.
    likely = cut_lineage(likely)
    few = F.broadcast(likely) if likely.count() <= BROADCAST_IDS else likely
    return _whole_sets(known.join(few, "id"))


def _open(role, node, component, n, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions of a looked-up node and of a member) in one block, enough to join all
    components that any link of a looked-up node and a member joins; fewer than there are rows."""
    ends = tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
    flat = tokens.flatten().to_numpy()
    of = np.repeat(np.arange(len(role)), np.diff(ends))
    union = np.unique(flat[role[of] == 0])
    place = np.minimum(np.searchsorted(union, flat), max(0, len(union) - 1))
    inside = union[place] == flat if len(union) else np.zeros(len(flat), bool)
    bound = np.bincount(of[inside], minlength=len(role))
    members = np.flatnonzero(role == 0)
    asked = np.flatnonzero((role == 1) & (bound * 100 >= n * PERCENT))
    # What is held at once is bounded by rows as by tokens: short texts make many rows of a block.
    slices = lambda rows: [rows[at : at + OPEN_ROWS] for at in range(0, len(rows), OPEN_ROWS)]
    of, place = of[inside], place[inside]
    _, label = np.unique(component, return_inverse=True)
    links = []
    for some in slices(asked):
        for others in slices(members):
            if (label[some] == label[others[0]]).all() and (label[others] == label[others[0]]).all():
                continue
            linked = _linked(some, others, n, of, place, len(union)) & (label[some][:, None] != label[others][None, :])
            for i in np.flatnonzero(linked.any(axis=1)):
                reached = others[linked[i]]
                joined, one = np.unique(label[reached], return_index=True)
                new = joined != label[some[i]]
                if new.any():
                    links += [(some[i], j) for j in reached[one[new]]]
                    label[np.isin(label, joined)] = label[some[i]]
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _linked(asked, members, n, of, place, width: int) -> np.ndarray:
    """Which of the rows ``asked`` and ``members`` are similar enough; ``of`` and ``place`` are the
    rows and the columns (below ``width``) of their tokens."""
    sides, used = [], np.ones(width, bool)
    for rows in (asked, members):
        row = np.full(len(n), -1)
        row[rows] = np.arange(len(rows))
        mine = row[of] >= 0
        sides.append((row[of[mine]], place[mine], len(rows)))
        held = np.zeros(width, bool)
        held[place[mine]] = True
        used &= held
    # Only tokens on both sides count; the incidence matrices are built some columns at a time.
    column = np.cumsum(used) - 1
    sorted_sides = []
    for row, at, size in sides:
        row, at = row[used[at]], column[at[used[at]]]
        order = np.argsort(at, kind="stable")
        sorted_sides.append((row[order], at[order], size))
    overlap = np.zeros((len(asked), len(members)), np.float32)
    total = int(used.sum())
    for left in range(0, total, OPEN_COLUMNS):
        matrices = []
        for row, at, size in sorted_sides:
            a, b = np.searchsorted(at, [left, left + OPEN_COLUMNS])
            matrix = np.zeros((size, min(OPEN_COLUMNS, total - left)), np.float32)
            matrix[row[a:b], at[a:b] - left] = 1
            matrices.append(matrix)
        overlap += matrices[0] @ matrices[1].T
    overlap = overlap.astype(np.int64)
    union_size = n[asked][:, None] + n[members][None, :] - overlap
    return overlap * 100 >= union_size * PERCENT


def _look_up(members: DataFrame, asked: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between nodes ``asked`` and ``members`` of a group that are of different
    components; both are (grp, node, component, n)."""

    def blocked(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias(name))

    counts = blocked(members, "m").join(blocked(asked, "q"), "grp")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    own = lambda name: F.pmod(F.xxhash64("node"), F.col(name)).cast("int")
    columns = ["grp", "role", "node", "component"]
    left = members.join(counts, "grp").select(*columns[:1], F.lit(0).alias("role"), *columns[2:], own("m").alias("i"), every("q").alias("j"))
    right = asked.join(counts, "grp").select(*columns[:1], F.lit(1).alias("role"), *columns[2:], every("m").alias("i"), own("q").alias("j"))
    rows = left.unionByName(right).join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        get = lambda name: table.column(name).to_numpy()
        node = get("node")
        a, b = _open(get("role"), node, get("component"), get("n"), table.column("tokens").chunk(0))
        return pa.table({"a": pa.array(node[a], pa.int64()), "b": pa.array(node[b], pa.int64())})

    return rows.groupBy("grp", "i", "j").applyInArrow(run, "a long, b long")


def _links(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links enough to join all nodes of a class."""
    sets = cut_lineage(_candidates(known, nodes))
    # Overlap o of sets x and y is at most what either shares with anyone: 100 o >= P (x + y - o)
    # then bounds the size of a partner by reach = (100 + P) / P * shared - n.
    shared = _with_shared_tokens(sets, "tokens").withColumn("common", F.size("shared")).where(F.col("common") >= _need())
    # Stored with the mark of index shingles in the last bit of the size, as there are very many rows.
    stored = cut_lineage(
        shared.select(
            "node", "n",
            ((100 + PERCENT) * F.col("common") / PERCENT - F.col("n")).alias("reach"),
            (F.col("common") - _need_of_larger()).alias("last"),
            F.posexplode(F.slice("shared", F.lit(1), (F.col("common") - _need() + 1).cast("int"))).alias("at", "t"),
        ).select("node", (2 * F.col("n") + (F.col("at") <= F.col("last")).cast("long")).alias("marked"), "reach", "t.token")
    )
    rare = stored.select("node", F.shiftright("marked", 1).alias("n"), "reach", "token", (F.col("marked") % 2 == 1).alias("index"))
    leaders = rare.groupBy("token").agg(F.min("node").alias("grp"), F.count("*").alias("holders")).where("holders > 1")
    led = rare.join(leaders.drop("holders"), "token").groupBy("node", "n", "reach", "grp").agg(F.count("*").alias("votes"))
    grouped = cut_lineage(
        led.groupBy("node", "n", "reach").agg(F.min_by("grp", F.struct(-F.col("votes"), "grp")).alias("grp"))
    )
    heads = (
        grouped.select("grp").distinct().withColumn("node", F.col("grp"))
        .join(grouped.select("node", "n"), "node").withColumn("component", F.col("node")).distinct()
    )
    first = cut_lineage(_look_up(heads, grouped.select("grp", "node", "n", F.col("node").alias("component")), sets))
    found = connected_components(first)
    placed = cut_lineage(
        grouped.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    )
    # Of a pair the larger node is looked up in groups that hold one of its rare shingles as an index shingle, of
    # nodes that it can link with by size; in its own group, only if it isn't in the component of that group's leader.
    head_of = placed.select(F.col("node").alias("grp"), F.col("component").alias("head"))
    where = placed.join(head_of, "grp").select("node", "grp", "component", "head")
    held = (
        rare.where("index").join(where, "node").groupBy("token", "grp").agg(
            F.min("n").alias("least"), F.max("n").alias("largest"), F.max("reach").alias("most"),
            F.min("component").alias("c0"), F.max("component").alias("c1"),
        )
    )
    by_size = f"least <= n AND n <= most AND largest * 100 >= n * {PERCENT}"
    asked = (
        rare.join(where.withColumnRenamed("grp", "own"), "node")
        .join(
            held.where(F.col("token").isNotNull()), "token"
        )
        .where(f"(own != grp OR component != head) AND {by_size} AND (c0 != c1 OR c0 != component)")
        .select("grp", "node", "component", "n").distinct()
    )
    second = _look_up(placed.select("grp", "node", "component", "n"), asked, sets)
    return first.unionByName(second)


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``, the smallest
    id that links reach, the row's own included.

    A null, empty or blank text has no shingles and links with nothing. Rows with a null id get
    a null component and link nothing. Rows of one id are one node with several texts. Other
    columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = cut_lineage(sketches(texts))
    nodes = (
        rows.where("id IS NOT NULL AND n > 0").groupBy("h0", "h1", "n")
        .agg(F.min("id").alias("node"), F.first("sketch").alias("sketch"))
    )
    named = cut_lineage(nodes)
    links = _links(texts.where("id IS NOT NULL"), named)
    # Nodes of one id with several texts, and texts of several ids, meet here.
    known = rows.where("id IS NOT NULL AND n > 0").select("id", "h0", "h1", "n").join(named.drop("sketch"), ["h0", "h1", "n"])
    repeated = known.where("id != node").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b")
    same_id = known.join(repeated.select("id"), "id").select(F.col("id").alias("a"), F.col("node").alias("b")).where("a != b")
    found = connected_components(links.unionByName(same_id))
    classes = known.join(found, "node", "left").select("id", "h0", "h1", "n", F.coalesce("component", "node").alias("component")).distinct()
    return (
        rows.drop("sketch").join(classes, ["id", "h0", "h1", "n"], "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
