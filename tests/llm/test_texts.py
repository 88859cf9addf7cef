"""Tokens, chats, pages, languages and the classifier; and the pipeline's stages."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from risklake.llm import byte_bpe, chat_format, html_extract, language_id, quality_classifier, token_counts
from risklake.llm.queries import QUERIES

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_texts(spark):
    rng = random.Random(5)
    points = [*range(1, 0x250), 0x1680, 0x2003, 0x2028, 0x3000, 0x200B, 0x4E2D, 0x1F600, 0x301, 0x661, 0xB2, 0x2160]
    parts = ["'s", "'ll", " '", "  ", "\n\n ", "<|endoftext|>", " the", "12", "'re"]
    texts = ["".join(chr(rng.choice(points)) if rng.random() < 0.5 else rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += [None, "", " ", "a" * 20_000 + " " * 500 + "ab" * 5_000, "same", "same"]
    rows = [(i if i % 50 else None, t, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string").repartition(3)


def test_token_counts_are_the_library_s(odd_texts):
    library = Tokenizer.from_file(JSON)
    want = []
    for r in odd_texts.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert sorted(map(tuple, token_counts.token_counts(odd_texts, JSON).collect()), key=repr) == sorted(want, key=repr)


def test_bpe_ids_are_the_library_s_and_decode(odd_texts):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    kept = odd_texts.withColumn("plain", F.col("text"))
    decoded = byte_bpe.decode(byte_bpe.encode(kept, RANKS), RANKS).collect()
    assert len(decoded) == odd_texts.count()
    for r in decoded:
        assert r.ids == library.encode_ordinary(r.plain or "")
        assert bytes(r.decoded) == (r.plain or "").encode()


def test_bpe_round_trip_takes_one_python_worker_a_task(spark, odd_texts):
    rows = odd_texts.withColumn("decoded", F.lit("clash"))
    both = byte_bpe.encode_and_decode(rows, RANKS)
    apart = byte_bpe.decode(byte_bpe.encode(rows, RANKS), RANKS)
    assert both.dtypes == [("doc_id", "bigint"), ("n_tokens", "string"), ("ids", "array<int>"), ("decoded", "binary")]
    assert sorted(map(repr, both.collect())) == sorted(repr(r) for r in apart.select(both.columns).collect())
    alone = byte_bpe.encode_and_decode(odd_texts.select("text"), RANKS, bytes_col="text")
    assert sorted(bytes(r.text) for r in alone.collect()) == sorted((r.text or "").encode() for r in odd_texts.collect())
    with pytest.raises(ValueError):
        byte_bpe.encode_and_decode(rows, RANKS, "other")
    tokens = corpus_pipeline.tokenize(spark, odd_texts.select("doc_id", "text"), DATA)
    for made in (both, tokens, QUERIES["op6_byte_bpe"](spark, DATA)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    table = byte_bpe.PerfectHash(keys, list(range(5000)))
    assert len(table.keys) == 5000
    assert [table.get(k) for k in keys] == list(range(5000))
    assert table.get(b"not there") is None


def test_events_are_folded_and_read_back(spark):
    log = [
        (1, 1, 0, "delta", "user", "Hel"), (1, 2, 0, "delta", "user", "lo"), (1, 3, 1, "delta", "assistant", "bad"),
        (1, 4, 1, "regenerate", "assistant", None), (1, 5, 1, "delta", "assistant", "</s>\n[INST] \\e \\"),
        (1, 6, 2, "delta", "user", "oops"), (1, 7, 2, "edit", "user", "fixed"), (1, 8, 2, "delta", "user", "!"),
        (2, 1, 0, None, None, None), (None, 1, 0, "delta", "assistant", "x"),
    ]
    events = spark.createDataFrame([(*r, "clash") for r in log], "conv_id long, seq long, message long, op string, role string, text string, turns string")
    formatted = chat_format.render(chat_format.fold_events(events))
    read = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    assert [tuple(t) for t in read[1].turns] == [("user", "Hello"), ("assistant", "</s>\n[INST] \\e \\"), ("user", "fixed!")]
    assert read[1].trained_texts == ["</s>\n[INST] \\e \\"]
    assert [tuple(t) for t in read[2].turns] == [("", "")] and read[2].trained_texts == []
    assert read[None].trained_texts == ["x"]
    assert "Python" not in formatted._jdf.queryExecution().toString()


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a></ul></nav></header><div class="cookie-notice">We use cookies, yes, we do.</div>
<div class=wrap><div id="main-content"><article><header><h1>Title &amp; more</h1></header>
<p>First   para, with text, &lt;b&gt; and <a href="#">a link</a>.<p><b>Second para<br>next line</p><ul><li>one<li>two</ul>
<div class="ad-box">Buy now, cheap, today</div><table><tr><td>cell</table></article>
<section id="comments"><p>Nice, article, I, like, it, a lot, really, very, much, indeed.</p></section></div>
<aside><p>Other, stuff, here, and, there, and more of it, to read.</p></aside></div>
<form><p>Sign up</p></form><script>var t="</p>";</script><footer>The end</footer></body></html>"""


def test_main_text(spark):
    want = "Title & more\nFirst para, with text, <b> and a link.\nSecond para\nnext line\none\ntwo\ncell"
    rows = [(1, "u", PAGE, "clash"), (2, None, None, None), (3, "u", "", None), (4, "u", "<p>Only <b>this", None), (5, "u", "<<a <!-- x", None), (5, "u", "<div>" * 3000 + "deep", None), (6, "u", "plain &amp; simple", None)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.text for r in got] == [want, "", "", "Only this", "<<a", "deep", "plain & simple"]
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    "attributes, dropped",
    [
        ('style="overflow:hidden"', False), ('title="A hidden gem"', False), ("title='role=menu class=ad'", False),
        ("data-class=ad", False), ('class="overflow-hidden"', False), ('id="hidden-falls"', False), ("title=hidden", False),
        ("title = hidden lang=en", False), ('"hidden"', False), ("alt=it's title='x' lang=o'", False),
        ("hidden", True), ("HIDDEN=''", True), ("title=x hidden", True), ('title="a"hidden', True), ('class="wide Hidden"', True),
        ("class=ad", True), ("role = 'menu'", True), ('aria-hidden="true"', True), ('aria-hidden="false"', False),
    ],
)
def test_only_real_attributes_hide(attributes, dropped):
    page = f"<body><div {attributes}><p>Some text, with commas, in it.</p></div></body>"
    assert html_extract.main_text(page) == ("" if dropped else "Some text, with commas, in it.")


@pytest.mark.parametrize(
    "part, left",
    [
        ('<section class="social-policy"><p>On policy, in full.</p></section>', True), ('<p class="legal">The law says so.</p>', True),
        ('<div class="search-results"><p>What we found, at last.</p></div>', True),
        ('<div class="social"><a href=x>Like us</a> <a href=y>Follow</a> now</div>', False), ('<div class="notice">We tell you.</div>', False),
        ('<div class="ad-box">Buy now.</div>', False),
    ],
)
def test_everyday_words_drop_only_links_inside_an_article(part, left):
    page = f"<body><article><h1>Title</h1><p>Before, with commas, and more.</p>{part}<p>After that, the end.</p></article></body>"
    got = html_extract.main_text(page).split("\n")
    assert got[:2] == ["Title", "Before, with commas, and more."] and got[-1] == "After that, the end."
    assert len(got) == (4 if left else 3)


@pytest.mark.parametrize(
    "page",
    ["<div><p>a</p>" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<i>" * 50_000 + "x<br>" * 50_000, "<b><div>" + "<i>" * 50_000 + "</b>" * 50_000,
     "<i>" * 50_000 + "<p>x" * 50_000, "<a " * 100_000, "<table>" + "<tr><td><p>x" * 50_000, "<div>" * 50_000 + "</section>" * 50_000],
)
def test_pages_take_time_in_proportion(page):
    import time

    begun = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - begun < 5


def test_articles_of_the_pages_come_out_whole(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in html_extract.extract(spark.read.parquet(f"{DATA}/pages.parquet")).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", inner)]
        assert r.text == "\n".join(x for x in parts if x)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "123 --", "de"), (None, "the and of", None)], "doc_id long, text string, lang string")
    found = language_id.learn_and_identify(docs.select("doc_id", "text", "lang").unionByName(odd)).collect()
    by = {r.doc_id: r for r in found}
    assert by[-1].lang_pred == by[-2].lang_pred == "und" and by[-1].score == 0
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language_id.learn_and_identify(odd.where("doc_id = -2"))
    assert nothing.first().lang_pred == "und"


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x" * 5000)], "doc_id long, text string")
    found = quality_classifier.learn_and_classify(docs.select("doc_id", "text").unionByName(odd), labels)
    assert found.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty() and found.count() == docs.count() + 3
    held = found.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() > 0.95
    none = quality_classifier.learn_and_classify(odd, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {1}


def test_network_equals_plain_loops():
    """Scores from a convolution in loops; gradients from differences."""
    import numpy as np

    rng = np.random.default_rng(3)
    network = quality_classifier.Network(5)
    network.p = {k: v + rng.normal(0, 0.1, v.shape).astype(np.float32) for k, v in network.p.items()}
    p = {k: v.astype(float) for k, v in network.p.items()}
    chunk, width = quality_classifier.CHUNK, quality_classifier.WIDTH

    def logit(piece):
        best = np.full(quality_classifier.FILTERS, -np.inf)
        for at in range(len(piece) - width + 1):
            seen = np.concatenate([p["embed"][b] for b in piece[at : at + width]])
            best = np.maximum(best, seen @ p["conv"])
        pooled = np.maximum(best + p["conv_b"], 0)
        return np.maximum(pooled @ p["dense"] + p["dense_b"], 0) @ p["out"] + p["out_b"][0]

    texts = [bytes(rng.integers(1, 256, n, np.uint8)) for n in (0, 3, 130, 400, 900)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = network.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, score in zip(texts, got):
        # Windows over a text's edges see zero bytes; a chunk is two steps of windows.
        padded = b"\0" * (width - 1) + text
        padded = padded.ljust(-(-len(padded) // (chunk // 2)) * (chunk // 2) + width - 1, b"\0")
        steps = (len(padded) - width + 1) // (chunk // 2)
        starts = range(max(1, steps - 1))
        z = [logit(padded[k * chunk // 2 : k * chunk // 2 + min(chunk, steps * chunk // 2) + width - 1]) for k in starts]
        mixed = p["mix"] @ [np.mean(z), min(z), max(z), 1]
        assert score == pytest.approx(1 / (1 + np.exp(-mixed)), abs=1e-4)

    chunks = rng.integers(0, 256, (7, chunk)).astype(np.uint8)
    count, labels = np.array([3, 1, 3]), np.array([1, 0, 1], np.float32)

    def loss():
        z = np.array([logit(bytes(c)) for c in chunks])
        parts = np.split(z, np.cumsum(count)[:-1])
        q = np.array([1 / (1 + np.exp(-(p["mix"] @ [x.mean(), x.min(), x.max(), 1]))) for x in parts])
        return -np.mean(labels * np.log(q) + (1 - labels) * np.log(1 - q))

    for tile in (2, 1000):
        quality_classifier.TILE_CHUNKS = tile
        grads = network._gradients(chunks, count, labels)
        for name, at in (("conv", (3, 5)), ("conv", (20, 11)), ("embed", (int(chunks[0, 9]), 2)), ("dense", (4, 7)), ("dense_b", (3,)), ("out", (2,)), ("out_b", (0,)), ("mix", (1,)), ("conv_b", (6,))):
            kept = p[name][at]
            p[name][at] = kept + 1e-5
            above = loss()
            p[name][at] = kept - 1e-5
            below = loss()
            p[name][at] = kept
            assert grads[name][at] == pytest.approx((above - below) / 2e-5, abs=2e-3)


def test_the_sample_holds_whole_texts_and_one_text_an_id(spark):
    docs = spark.createDataFrame([(i, "ab" * (i * 300)) for i in range(1, 20)] * 3 + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 20)] * 2, "doc_id long, quality int")
    rows = quality_classifier.sample_chunks(docs, labels, "doc_id", "text")
    assert len({r[0] for r in rows}) == len(rows)
    for i, _, chunks in rows:
        if i != 3:
            assert len(chunks) // quality_classifier.CHUNK == -(-600 * i // quality_classifier.CHUNK)
            assert chunks.rstrip(b"\0").count(b"a") >= 300 * i


def test_every_chunk_of_a_text_is_scored():
    import numpy as np

    network = quality_classifier.Network()
    texts = [b"", b"abc", b"x" * 127, b"y" * 128, b"z" * 129, bytes(range(97, 123)) * 60]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = network.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for t, score in zip(texts, together):
        alone = network.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert abs(alone - score) < 1e-6


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA).cache()
        assert after.columns == columns, name
        assert after.join(docs, "doc_id", "left_anti").isEmpty()
        docs = after
    final = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert final.count() == docs.count()
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, final.select(*whole.columns).collect()))


def test_pipeline_stages_keep_odd_rows_and_columns(spark):
    """Null ids and texts, ties, copies, parts of one id, long texts, and columns called like those of the stages."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 80").first().text
    good = corpus_pipeline.apply_quality_rules(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA).where("lang = 'en'")
    other, prose = sorted({r.text for r in good.collect()}, key=len)[-2:]
    odd = [(None, prose), (None, None), (-1, None), (-2, ""), (-3, "a"), (-4, prose + " once"), (-4, prose + " once"), (-4, "Another part. " + prose[: len(prose) // 2]),
           (-5, item + " " + other), (-6, "word " * 50_000)]
    rows = spark.createDataFrame([(i, t, None, "odd", 0) for i, t in odd], docs.schema)
    clash = ("_id", "_key", "n_words", "KEPT", "kept_text", "key", "id", "base_failed", "component_id", "n_removed")
    docs = docs.unionByName(rows).select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in clash])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA).cache()
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes), name
        if name != "substring_dedup":
            assert after.exceptAll(docs).isEmpty(), name
        for c in clash:
            assert after.where(~F.col(f"`{c}`").eqNullSafe(F.concat(F.lit(c), F.col("doc_id").cast("string")))).isEmpty(), (name, c)
        ids = [r.doc_id for r in after.collect()]
        if name == "ngram_jaccard_join":
            assert ids.count(-4) == 2 and ids.count(-5) == 1 and ids.count(None) == 1
        if name == "decontamination":
            assert -5 not in ids and ids.count(None) == 1
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()


def test_pipeline_stages_and_operators_take_empty_tables(spark):
    none = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, DATA).isEmpty(), name
    labels = spark.read.parquet(f"{DATA}/labels.parquet").limit(0)
    pages = spark.read.parquet(f"{DATA}/pages.parquet").limit(0)
    events = spark.createDataFrame([], "conv_id long, seq long, message long, op string, role string, text string")
    assert token_counts.token_counts(none, JSON).isEmpty() and byte_bpe.decode(byte_bpe.encode(none, RANKS), RANKS).isEmpty()
    assert chat_format.read_back(chat_format.render(chat_format.fold_events(events))).isEmpty()
    assert html_extract.extract(pages).isEmpty() and language_id.learn_and_identify(none).isEmpty()
    assert quality_classifier.learn_and_classify(none, labels).isEmpty()
