"""Operators on words and windows against brute force, odd rows included."""

import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from risklake.llm import decontaminate, ngram_jaccard, quality_rules, substring_dedup
from risklake.llm.fm_index import FMIndex, WaveletMatrix

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, n_words string, id string"


def words(seed, n):
    return [f"w{x}é" if x % 7 == 0 else f"w{x}" for x in np.random.default_rng(seed).integers(0, 40, n)]


@pytest.fixture(scope="module")
def rows():
    """Near and exact copies, shared passages, short, empty, null, long and repeated rows."""
    base, passage = words(1, 120), words(2, 70)
    texts = {1: base, 2: base, 3: [*base[:60], "edit", *base[61:]], 4: [*words(3, 30), *passage, *words(4, 30)]}
    texts |= {5: [*words(5, 5), *passage], 6: [*passage[:55], *words(6, 40)], 7: ["a", "b"], 8: ["A", "B"]}
    texts |= {i: [*words(i, 20), *passage[i % 9 : 60 + i % 5], *words(100 + i, 30)] for i in range(20, 60)}
    texts |= {i: [w if k % 60 != i % 60 else f"x{i}" for k, w in enumerate(base)] for i in range(60, 90)}
    out = [(i, " ".join(t), "en", "clash", "clash") for i, t in texts.items()]
    out += [(100, None, None, None, None), (101, "", "en", None, None), (102, " \t\n ", "en", None, None)]
    out += [(103, " ".join(words(7, 6000) + passage), "de", None, None), (None, " ".join(passage), "en", None, None)]
    return out + [out[0]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_wavelet_ranks():
    symbols = np.random.default_rng(0).integers(0, 50, 1000)
    wavelet = WaveletMatrix(symbols, 6)
    for c in (0, 7, 49):
        at = np.arange(0, 1001, 13)
        got = wavelet.descend(np.full(len(at), c), at) - wavelet.descend(np.array([c]), np.array([0]))
        assert got.tolist() == [int((symbols[:i] == c).sum()) for i in at]


def test_index_finds_windows_of_smaller_owners():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 3, n) for n in rng.integers(6, 40, 60)]
    owners = rng.integers(0, 20, 60)
    index = FMIndex(np.concatenate(parts), np.array([len(p) for p in parts]), owners)
    found = index.shared_windows(6)
    least = {}
    for p, o in zip(parts, owners):
        for k in range(len(p) - 5):
            key = tuple(p[k : k + 6])
            least[key] = min(least.get(key, 99), o)
    for start, p, o in zip(index.starts, parts, owners):
        for k in range(len(p) - 5):
            assert found[start + k] == (least[tuple(p[k : k + 6])] < o)


def kept_words(rows):
    seen = {}
    for i, text, *_ in rows:
        w = SPACED.findall(text or "")
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if i is not None:
                seen[key] = min(seen.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = SPACED.findall(text or "")
        gone = set()
        for k in range(len(w) - 49):
            if i is not None and seen[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [512, 1])
def test_passages_are_removed(docs, rows, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP_SEGMENTS", group)
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text", "lang").collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == kept_words(rows)
    assert sum(r.n_removed for r in got) > 1000


def test_a_passage_in_very_many_documents(spark, monkeypatch):
    """Edges differ everywhere; a template's middle differs too; one document repeats the passage."""
    rng = np.random.default_rng(9)
    passage, head, tail = ([f"{p}{k}" for k in range(n)] for p, n in (("p", 70), ("h", 30), ("t", 30)))
    own = lambda n: [f"w{rng.integers(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(own(rng.integers(40)) + passage[rng.integers(10) : 60 + rng.integers(11)] + own(rng.integers(40)))) for i in range(2000)]
    rows += [(5000 + i, " ".join(head + own(1) + tail)) for i in range(1500)]
    rows += [(-1, " ".join(x for _ in range(300) for x in own(1) + passage)), (9000, " ".join(head + tail))]
    made = []
    cut = substring_dedup._cut
    monkeypatch.setattr(substring_dedup, "_cut", lambda f, level: made.append((f.count(), cut(f, level).count())) or cut(f, level))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == kept_words(rows)
    # Not a row for each of a segment's windows.
    assert made and made[0][1] < 16 * made[0][0]


def test_crowded_anchors_are_cut_once_and_in_proportion(spark, monkeypatch):
    """Twice the documents around a passage make at most about twice the pieces of a level; none is made again."""
    monkeypatch.setattr(substring_dedup, "GROUP_SEGMENTS", 32)
    rng = np.random.default_rng(11)
    own = lambda n: [f"w{rng.integers(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(own(20 + i % 20) + [f"p{k}" for k in range(i % 7, 65)] + own(30))) for i in range(600)]
    cut, run, needed = substring_dedup._cut, {}, {}

    def counted(fetched, level):
        needed[level] = cut(fetched, level).count()
        made = run[level] = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        pieces = cut(fetched, level)
        return pieces.mapInArrow(count, pieces.schema)

    monkeypatch.setattr(substring_dedup, "_cut", counted)
    first = []
    for n in (300, 600):
        run.clear(), needed.clear()
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(4)
        got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
        assert sorted(map(tuple, got), key=repr) == kept_words(rows[:n])
        assert needed and {k: m.value for k, m in run.items()} == needed
        first.append(needed[0])
    assert first[1] < 2.3 * first[0]


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_similarity_classes(docs, rows):
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            sets.setdefault(i, shingles(text))
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = ngram_jaccard.similarity_classes(docs).collect()
    assert len(got) == len(rows) and len(links) > 30
    for r in got:
        assert r.component_id == (None if r.doc_id is None else least[r.doc_id])
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[r.doc_id])


def test_blocks_of_a_group_are_all_opened(docs, monkeypatch):
    want = sorted(ngram_jaccard.similarity_classes(docs).collect(), key=repr)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(ngram_jaccard, "BROADCAST_IDS", 0)
    assert sorted(ngram_jaccard.similarity_classes(docs).collect(), key=repr) == want


def opened(sets, component, roles):
    """``_open`` on sets that are members, looked up or both; the links as pairs of sets."""
    rows = [(r, i) for i, both in enumerate(roles) for r in both]
    role, node = (np.array(x) for x in zip(*rows))
    tokens = ngram_jaccard._lists([np.array(sorted(sets[i]), np.uint64) for i in node])
    a, b = ngram_jaccard._open(role, node, np.array(component)[node], np.array([len(sets[i]) for i in node]), tokens)
    assert (role[a] == 1).all() and (role[b] == 0).all()
    return list(zip(node[a].tolist(), node[b].tolist()))


@pytest.mark.parametrize("rows", [1, 7, 1024])
def test_slices_of_a_block_join_what_its_links_join(monkeypatch, rows):
    monkeypatch.setattr(ngram_jaccard, "OPEN_ROWS", rows)
    monkeypatch.setattr(ngram_jaccard, "OPEN_COLUMNS", 16)
    rng = np.random.default_rng(rows)
    bases = [set(rng.choice(200, 20, replace=False).tolist()) for _ in range(6)]
    sets = [bases[i % 6] - {rng.integers(200)} | {int(rng.integers(200)) for _ in range(i % 4)} for i in range(90)]
    component = [i if i % 5 else i % 6 for i in range(90)]
    roles = [[0], [1], [0, 1]] * 30

    def classes(links):
        least = component[:]
        for _ in sets:
            for i, j in links:
                low = min(least[i], least[j])
                least = [low if x in (least[i], least[j]) else x for x in least]
        return least

    similar = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    asked, members = ([i for i in range(90) if r in roles[i]] for r in (1, 0))
    every = [(i, j) for i in asked for j in members if i != j and similar(sets[i], sets[j])]
    got = opened(sets, component, roles)
    assert set(got) <= set(every) and 10 < len(got) < len(set(component)) < len(every)
    assert classes(got) == classes(every)


@pytest.mark.parametrize("near", [False, True])
def test_a_block_of_many_short_texts_fits(near):
    # 3,000 texts of 8 shingles, 7 of them shared, don't link; of 10 with 9 shared, all do.
    n = 3000
    shared = range(9 if near else 7)
    sets = [{*shared, 100 + i} for i in range(n)]
    tracemalloc.start()
    got = opened(sets, range(n), [[0, 1]] * n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == (n - 1 if near else 0)
    assert peak < 120e6


def test_a_template_s_texts_are_not_compared_with_each_other(spark, monkeypatch):
    asked = []
    look_up = ngram_jaccard._look_up
    monkeypatch.setattr(ngram_jaccard, "_look_up", lambda m, q, s: asked.append(q.count()) or look_up(m, q, s))
    texts = [" ".join([*(f"t{k}" for k in range(11)), f"end{i}"]) for i in range(40)]
    got = ngram_jaccard.similarity_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.n_shingles == 8 and r.component_id == r.doc_id for r in got) and len(got) == 40
    assert asked == [40, 0]


def test_pairs_on_a_template_ask_in_proportion(spark, monkeypatch):
    """Near copies in pairs, all on one template: 84 shared words, 19 of the pair, one of the text."""
    asked = []
    look_up = ngram_jaccard._look_up
    monkeypatch.setattr(ngram_jaccard, "_look_up", lambda m, q, s: asked.append(q.count()) or look_up(m, q, s))
    counts = []
    for n in (100, 200, 400):
        texts = [" ".join([*(f"t{k}" for k in range(84)), *(f"p{i // 2}_{k}" for k in range(19)), f"own{i}"]) for i in range(n)]
        asked.clear()
        got = ngram_jaccard.similarity_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in got) and len(got) == n
        counts.append(sum(asked))
    assert counts[2] <= 4.4 * counts[0] and counts[2] <= 4 * 400


def test_quality_counts(docs, rows):
    got = {(r.doc_id, r.text): r for r in quality_rules.quality(docs).collect()}
    for i, text, *_ in rows:
        w, r = SPACED.findall(text or ""), got[i, text]
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if SPACED.search(line):
                dup += line in seen
                seen.add(line)
        often = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        repeat = {k + j for k in range(len(w) - 4) if often[tuple(w[k : k + 5])] > 1 for j in range(5)}
        failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), dup, len(repeat), failed)
        assert not (failed and r.kept)


def test_quality_keeps_prose_and_rejects_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    noise = docs.where("lang = 'en'").limit(20).select(
        (F.col("doc_id") + 10**6).alias("doc_id"), F.regexp_replace("text", r"(\w+)", "$1 ###&&&").alias("text"), "lang", "source", "n_chars"
    )
    judged = quality_rules.quality(docs.unionByName(noise)).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id", "left").toPandas()
    good = judged[(judged.quality == 1) & ~judged.base_failed]
    assert good.kept.mean() > 0.98
    assert not judged[(judged.doc_id >= 10**6) & (judged.word_chars > 400)].kept.any()


@pytest.mark.parametrize("counted", [50, 200_000])
def test_reference_words_are_counted_whole(spark, monkeypatch, counted):
    # "late" is rarer than 5,000 words of its own task, but common in all tasks together.
    monkeypatch.setattr(quality_rules, "COUNTED_WORDS", counted)
    monkeypatch.setattr(quality_rules, "COMMON", 8)
    texts = [" ".join(f"p{part}x{k} p{part}x{k}" for k in range(5000)) + " late" for part in range(6)]
    rows = [(t, lang) for t in texts for lang in ("en", "de")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 12), "text string, lang string")
    found = quality_rules.references(docs)
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    got = {(r.lang, r.kind, r.name): r.n for r in found.collect()}
    for lang in ("en", "de"):
        assert got[lang, "all", ""] == 6 * 10_001 and got[lang, "word", "late"] == 6
        assert sum(k[:2] == (lang, "word") for k in got) == quality_rules.COMMON
        assert sum(k[:2] == (lang, "class") for k in got) == quality_rules.CLASSES


def test_quality_rejects_texts_without_a_common_word(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(11)
    gibberish = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, rng.integers(5, 11)))) for _ in range(n))
    odd = spark.createDataFrame([(-n, gibberish(n), None) for n in (45, 60, 100, 150, 200, 500, 3000)], docs.schema)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality_rules.quality(docs.unionByName(odd)).join(labels, "doc_id", "left")
    of_words = np.interp([40, 3000], *quality_rules.MAX_WORD_DISTANCE)
    seen = judged.where("doc_id < 0 OR quality = 1").select("doc_id", "n_words", "base_failed", "kept", "word_distance", "class_distance").collect()
    strange = [r for r in seen if r.doc_id < 0]
    assert len(strange) == 7 and all(not r.base_failed and r.class_distance < quality_rules.MAX_CLASS_DISTANCE for r in strange)
    assert not any(r.kept for r in strange) and min(r.word_distance for r in strange) > of_words.max()
    good = [r for r in seen if r.doc_id >= 0 and not r.base_failed and r.class_distance is not None]
    assert all(r.kept for r in good if r.class_distance <= quality_rules.MAX_CLASS_DISTANCE)


def test_contamination(spark, docs, rows):
    passage = words(2, 70)
    items = [("i1", " ".join(passage[10:40])), ("i2", "W1 " + passage[3]), ("i3", None), ("i4", "..."), (None, " ".join(passage[30:42])), ("i1", " ".join(passage[10:40]))]
    table = spark.createDataFrame([(*x, "clash") for x in items], "item_id string, text string, doc_id string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    want = []
    for i, text, *_ in rows:
        w, hit, found = cut(text), set(), set()
        for name, t in items:
            iw = cut(t)
            n = min(10, len(iw))
            for k in range(len(iw) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == iw[k : k + n]:
                        hit.update(range(p, p + n))
                        found.add(name or "null")
        want.append((i, len(w), len(hit), sorted(found), bool(hit)))
    got = decontaminate.contamination(docs, table).drop("key").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert "Python" not in decontaminate.contamination(docs, table)._jdf.queryExecution().toString()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(none).isEmpty()
    assert ngram_jaccard.similarity_classes(none).isEmpty()
    assert quality_rules.quality(none).isEmpty()
    assert decontaminate.contamination(none, items).isEmpty()


def test_kept_digest_of_empty_text(docs):
    got = substring_dedup.remove_repeats(docs).where("doc_id = 100").select(F.sha2("kept_text", 256)).first()[0]
    assert got == hashlib.sha256(b"").hexdigest()
