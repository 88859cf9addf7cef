"""Licence scans, centroid clustering and the repair of turns, against brute force."""

import hashlib
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from risklake.llm import centroid_tree, license_scan, turn_repair
from risklake.llm.license_templates import PHRASES, TEMPLATES
from risklake.llm.queries import QUERIES, _as_pattern

SMALL = (
    ("x", "open <<var;words=0-2>> shut <<beginOptional>>now <<beginOptional>>or<<endOptional>> later<<endOptional>>"),
    ("y", "<<beginOptional>>do<<endOptional>> open <<var;match=the door|it>> <<var;words=1-3>> end"),
    ("z", "door <<beginOptional>>door<<endOptional>> door shut"),
)


def expected_spans(text, templates):
    """Longest span of every template at every word, by trying all ends with a regular expression."""
    words = license_scan.words_of(text or "")
    found = set()
    for label, template in templates:
        pattern = re.compile(_as_pattern(license_scan.parse(template)))
        for start in range(len(words)):
            ends = [stop for stop in range(start + 1, len(words) + 1) if pattern.fullmatch("".join(f"{w} " for w in words[start:stop]))]
            if ends:
                found.add((label, start, max(ends)))
    return found


def test_spans_equal_regular_expressions(spark):
    rng = random.Random(3)
    vocabulary = ["open", "shut", "now", "or", "later", "do", "the", "door", "it", "end", "é", "other"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(25))) for _ in range(400)]
    texts += [None, "", " \n", "OPEN, the-DOOR; x end", "open shut " * 3000, "open shut", "open shut", "shut now"]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string, score string")
    found = {r.doc_id: r for r in license_scan.scan(docs, templates=SMALL, phrases=(("the door", "d"), ("or", "o"))).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        words = license_scan.words_of(text or "")
        assert found[i].n_words == len(words)
        if len(words) < 100:
            assert {tuple(s) for s in found[i].spans} == expected_spans(text, SMALL)
        said = [("d", k) for k in range(len(words) - 1) if words[k : k + 2] == ["the", "door"]] + [("o", k) for k, w in enumerate(words) if w == "or"]
        assert sorted(map(tuple, found[i].phrases)) == sorted(said)
        assert found[i].score == (1.0 if found[i].spans else 0.5 if said else 0.0)
    assert license_scan.scan(docs.limit(0)).collect() == []


def test_a_licence_is_found_with_its_regions_filled_and_not_with_another_word(spark):
    label, template = TEMPLATES[0]
    bare = re.sub(r"<<var;words=0-12>>", "2024 Some Body and others", template)
    bare = re.sub(r"<<var;words=1-12>>", "THE AUTHORS OR HOLDERS", bare)
    bare = re.sub(r"<<var;match=([^|>]*)[^>]*>>", r"\1", bare)
    text = re.sub(r"<<(begin|end)Optional>>", "", bare)
    texts = ["before " + text + " after", text.replace("free of charge", "for a charge"), text.split("THE SOFTWARE IS")[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: {s.label for s in r.spans} for r in license_scan.scan(docs).collect()}
    assert found == {0: {"mit"}, 1: set(), 2: set()}
    for number, (label, template) in enumerate(TEMPLATES):
        assert license_scan.Automaton(TEMPLATES, PHRASES).labels[number] == label


@pytest.mark.parametrize("bad", ["a <<what>> b", "<<beginOptional>>a", "<<endOptional>> a", "<<beginOptional>>a<<endOptional>>", "<<var;words=1-2>> a"])
def test_templates_that_cannot_be_used_are_refused(bad):
    with pytest.raises(ValueError):
        license_scan.Automaton((("x", bad),))


def lloyd(vectors, clusters, rounds, seed):
    """(id, components) -> centroids and assignment, one by one."""
    kept = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vectors)
    points = [list(v) for _, v in kept[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), k) for k, p in enumerate(points))

    for _ in range(rounds):
        mine = [near(v)[1] for _, v in vectors]
        points = [
            [sum(c) // len(c) for c in zip(*(v for (_, v), m in zip(vectors, mine) if m == k))] if k in mine else p
            for k, p in enumerate(points)
        ]
    return points, [near(v) for _, v in vectors]


def test_nearest_sees_all_ties_and_huge_values():
    rng = np.random.default_rng(1)
    for size, reach in ((40, 2), (300, 3), (60, centroid_tree.REACH)):
        points = rng.integers(-reach, reach + 1, (size, 4))
        vectors = np.concatenate([rng.integers(-reach, reach + 1, (500, 4)), points])
        number, best = centroid_tree.nearest(vectors, points, centroid_tree.build_tree(points))
        gaps = ((vectors[:, None].astype(object) - points[None]) ** 2).sum(axis=2).astype(np.int64)
        assert (best == gaps.min(axis=1)).all() and (number == gaps.argmin(axis=1)).all()


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 120, [float(x) for x in rng.integers(-3, 4, 3) / 1024]) for i in range(130)] + [(7, [0.5, 0.25, -0.1])] * 40
    dirty = [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 2.0]), (905, [1.0, 2.0, float("inf")])]
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows + dirty], "vec_id long, embedding array<double>, cluster string, inertia string").repartition(5)
    found = centroid_tree.cluster(table, clusters=8, rounds=6, dimensions=3).collect()
    whole = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows]
    points, near = lloyd(whole, 8, 6, centroid_tree.SEED)
    total = [sum(d for d, k in near if k == c) for c in range(8)]
    want = [(i, k, d, total[k], sum(total), points[k]) for (i, _), (d, k) in zip(whole, near)]
    assert sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found) == sorted(want)


def test_few_none_and_far_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroid_tree.cluster(spark.createDataFrame([], schema), dimensions=2).collect() == []
    few = spark.createDataFrame([(None, [3e38, 0.0]), (1, [-3e38, 0.0])], schema)
    rows = centroid_tree.cluster(few, dimensions=2).collect()
    assert sorted(r.distance for r in rows) == [0, 0] and {r.cluster for r in rows} == {0, 1}


def cheapest(rows):
    """(cost, audit, messages) by trying all edits; ``rows`` are (role, text, fault)."""
    from functools import lru_cache

    @lru_cache(maxsize=None)
    def best(at, state, inserts):
        options = []
        if at == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserts < 3:
            cost, audit, said = best(at, after, inserts + 1)
            options.append((cost + 5, "I" + audit, (("user" if after == "u" else "assistant") + ":", *said)))
        if at < len(rows):
            role, text, fault = rows[at]
            cost, audit, said = best(at + 1, state, 0)
            options.append((cost + 2, "D" + audit, said))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] == after or (role[:1] == "s" and state == ""):
                    cost, audit, said = best(at + 1, role[:1], 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *said)))
                cost, audit, said = best(at + 1, after, 0)
                options.append((cost + more + 1, "R" + audit, (("user" if after == "u" else "assistant") + f":{text}", *said)))
        return min(options) if options else (10**9, "", ())

    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def repaired_by_hand(conversations):
    want = {}
    for conv, rows in conversations.items():
        rows = sorted(((t is not None, t or 0, t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0], r[1], r[3].encode(), r[4].encode()))
        seen, told, illegal = set(), [], 0
        for k, (_, _, _, role, text) in enumerate(rows):
            core = text.strip("\t\n\v\f\r ")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((role, text, fault))
            illegal += k > 0 and rows[k - 1][3][:1] + role[:1] not in ("su", "ua", "au")
        turns = [r[2] for r in rows if r[2] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, _, f in told]
        cost, audit, said = cheapest(tuple(told))
        want[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, list(said))
    return want


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_repairs_are_the_cheapest_wherever_conversations_are_cut(spark, partitions):
    rng = random.Random(partitions)
    texts = ["Yes.", "No!", "cut", " \t", "", "So. \n", "Hm, é", "why?", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    conversations = {}
    for conv in [None, *range(60)]:
        conversations[conv] = [(rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(1, 14))]
    # One conversation with most of the rows, long runs and repeats; over many partitions.
    conversations[-5] = [(t // 2, ("user", "assistant")[t % 7 > 3], f"{t}." if t % 11 else "same.") for t in range(400)]
    flat = [(c, t, r, x, "clash", "clash") for c, rows in conversations.items() for t, r, x in rows]
    table = spark.createDataFrame(flat, "conv_id long, turn long, role string, text string, fault string, part string")
    found = turn_repair.summarize(turn_repair.repair(table, partitions)).collect()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired) for r in found}
    assert len(found) == len(conversations)
    want = repaired_by_hand(conversations)
    assert got == want


def test_runs_are_passed_in_powers():
    symbol = ("u", turn_repair.CUT)
    vector = turn_repair.END
    for rows in range(1, 40):
        vector = turn_repair._apply(turn_repair._power(symbol, 0), vector)
        assert vector == turn_repair.passed(symbol, rows, turn_repair.END)
    edits, state = turn_repair.unroll([(("u", turn_repair.FINE), 100_000)], 0, turn_repair.END, True)
    assert sum(c for _, c, _ in edits) == turn_repair.passed(("u", turn_repair.FINE), 100_000, turn_repair.END)[0] and state in (0, 3)


def test_a_frequent_row_and_a_long_text(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.lit(3).alias("turn"), F.lit("user").alias("role"), F.lit("Same.").alias("text"))
    long = spark.createDataFrame([(2, 1, "user", "x" * 2_000_000 + "."), (2, 2, "assistant", "Ok.")], rows.schema)
    edits = turn_repair.repair(rows.union(long), 6)
    assert turn_repair.ordered(rows, 6).count() == 1
    told = {r.conv_id: r for r in turn_repair.summarize(edits).collect()}
    assert told[1].duplicate == 29_999 and told[1].audit == "D" * 30_000 and told[1].cost == 60_000
    assert told[2].audit == "KK" and len(told[2].repaired[0]) == 2_000_006


def test_damage_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert turn_repair.summarize(turn_repair.repair(turn_repair.damage(spark.createDataFrame([], schema)))).collect() == []
    import zlib

    rows = [(c, t, "assistant", "One. Two") for c in (None, 1, 2) for t in (None, *range(30))]
    got = {}
    for r in turn_repair.damage(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.role, r.text, r.copies))
    for conv in (None, 1, 2):
        want = []
        for t in (None, *range(30)):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if t is None else t}".encode()) % 20
            if kind == 0:
                want.append((None, "", "", 0))
            else:
                text = {1: "", 2: "One Two"}.get(kind, "One. Two")
                want.append((t, "user" if kind == 4 else "assistant", text, 2 if kind == 3 else 1))
        assert sorted(got[conv], key=repr) == sorted(want, key=repr)
    lost = turn_repair.repair(spark.createDataFrame([(9, None, "", "", 0)], schema + ", copies long"))
    row = turn_repair.summarize(lost).first()
    assert (row.conv_id, row.gaps, row.cost, row.audit, row.repaired) == (9, 0, 0, "", [])


def test_the_queries_are_registered_and_keep_every_row(spark):
    from tests.conftest import SF_DIR

    for name, table in (("op11_license_scan", "documents"), ("op12_centroid_clustering", "embeddings")):
        assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    conversations = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    assert QUERIES["op13_turn_repair"](spark, SF_DIR).count() == conversations.select("conv_id").distinct().count()
