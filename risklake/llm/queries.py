"""Registered queries of the operators, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from risklake.llm import (
    byte_bpe,
    centroid_tree,
    chat_format,
    decontaminate,
    html_extract,
    language_id,
    license_scan,
    ngram_jaccard,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    turn_repair,
)
from risklake.session import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similarity_classes(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def conversation_events(rows: DataFrame) -> DataFrame:
    """A log of deltas: every row is a message of its own, in order of turn, role and text."""
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.select("conv_id", order.alias("seq"), order.alias("message"), F.lit("delta").alias("op"), "role", "text")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    formatted = chat_format.render(chat_format.fold_events(conversation_events(rows)))
    return _digest_chats(formatted)


def _digest_chats(formatted: DataFrame) -> DataFrame:
    read = chat_format.read_back(formatted)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join("trained_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_ids(byte_bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN))


def digest_ids(decoded: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of token ids and of the bytes they decode to; ``more`` columns stay."""
    return decoded.select(
        "doc_id", *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.learn_and_identify(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance",
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.learn_and_classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda *names: F.array_join(F.array_sort(F.array_distinct(F.concat(*names))), ",")
    starts = F.col("phrases.start")
    return found.select(
        "doc_id", "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined("phrases.label").alias("base_labels"), joined("phrases.label", "spans.label").alias("labels"),
        "score",
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_tree.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    components = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(components, 256).alias("centroid_sha256"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = turn_repair.summarize(turn_repair.repair(turn_repair.damage(rows)))
    return told.withColumn("repaired_sha256", F.sha2(F.array_join("repaired", "\n"), 256)).drop("repaired")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_ngram_jaccard_join, op2_token_counts, op3_substring_dedup, op4_chat_format, op5_html_extraction,
        op6_byte_bpe, op7_decontamination, op8_language_id, op9_quality_rules, op10_quality_classifier,
        op11_license_scan, op12_centroid_clustering, op13_turn_repair,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (s) WHERE a.doc_id != b.doc_id GROUP BY ALL
  ) p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)
),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
lowest AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM lowest LEFT JOIN n USING (doc_id)
"""

_OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM d WHERE len(w) >= 50)
),
hit AS (
  SELECT doc_id, p FROM win JOIN (SELECT h, min(doc_id) AS o FROM win GROUP BY h) USING (h) WHERE o < doc_id
),
word AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d)),
judged AS (
  SELECT word.doc_id, i, x,
         coalesce(i - max(hit.p) OVER (PARTITION BY word.doc_id ORDER BY i) < 50, false) AS gone
  FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND hit.p = i
),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT gone), '')) AS h
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(h, sha256('')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_ESCAPED = r"replace(replace(replace({}, '\', '\e'), '<', '\l'), '[', '\b')"
_OP4 = rf"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<s>[INST][/INST]</s>') + 1 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p
    FROM i WHERE len(w) > 0
  )
),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
    FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n
  )
),
hits AS (SELECT doc_id, n, p, item_id FROM dw JOIN iw USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, n, p FROM hits), generate_series(0, 9) AS g(k) WHERE k < n GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _as_pattern(parts) -> str:
    """A template's parts as a regular expression over words that each end with a space."""
    out = ""
    for part in parts:
        if part[0] == "word":
            out += f"{part[1]} "
        elif part[0] == "any":
            out += f"([^ ]+ ){{{part[1]},{part[2]}}}"
        elif part[0] == "either":
            out += "(" + "|".join("".join(f"{w} " for w in words) for words in part[1]) + ")"
        else:
            out += f"({_as_pattern(part[1])})?"
    return out


def _op11() -> str:
    patterns: dict[str, list[str]] = {}
    for label, template in license_scan.TEMPLATES:
        patterns.setdefault(label, []).append(_as_pattern(license_scan.parse(template)))
    places = " UNION ALL ".join(
        f"SELECT doc_id, p - 1 AS p, '{label}' AS label FROM word WHERE w[p:p + {len(phrase.split()) - 1}] = {phrase.split()}"
        for phrase, label in license_scan.PHRASES
    )
    spans = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label FROM d WHERE regexp_matches(t, ' ({'|'.join(found)})')" for label, found in patterns.items()
    )
    return rf"""
WITH d AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t
  FROM (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents)
),
word AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d),
places AS ({places}),
spans AS ({spans}),
base AS (SELECT doc_id, count(*) AS n, min(p) AS a, max(p) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM places GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT * FROM spans) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, a AS first_word, b AS last_word,
       coalesce(base.l, '') AS base_labels, coalesce(every.l, '') AS labels,
       CASE WHEN d.doc_id IN (SELECT doc_id FROM spans) THEN 1.0::DOUBLE WHEN n IS NOT NULL THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""


def _op12() -> str:
    ctes, assigned = [], """
SELECT vec_id, v, n.c AS cluster, n.d AS distance FROM (
  SELECT vec_id, v, list_min(list_transform(cs, lambda x: {{'d': list_sum(list_transform(list_zip(v, x.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': x.n}})) AS n
  FROM kept, (SELECT list({{'n': n, 'c': c}}) AS cs FROM c{0})
)"""
    for i in range(centroid_tree.ROUNDS + 1):
        ctes.append(f"a{i} AS MATERIALIZED ({assigned.format(i)})")
        ctes.append(f"""s{i} AS (
  SELECT cluster, p, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY cluster, p
),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.n, coalesce(m.c, c{i}.c) AS c
  FROM c{i} LEFT JOIN (SELECT cluster, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY p) AS c FROM s{i} GROUP BY cluster) m ON m.cluster = c{i}.n
)""")
    last = centroid_tree.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({centroid_tree.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {centroid_tree.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{centroid_tree.SEED}:' || vec_id)) - 1)::INTEGER AS n, v AS c FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('{centroid_tree.SEED}:' || vec_id)) <= {centroid_tree.CLUSTERS}
),
{", ".join(ctes)}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON c{last}.n = cluster
"""


#: Forward search instead of run-length search: per state after every row the cheapest (cost, audit), smallest first.
_OP13 = r"""
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM conversations
),
made AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM told, generate_series(1, 2) AS g(copy) WHERE kind != 0 AND (copy = 1 OR kind = 3)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM made)
),
row_ AS (
  SELECT conv_id, turn, role, text, i, role[1] AS r,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed
),
search AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': ''} AS s0, {'c': 99999999, 'a': ''} AS s1, {'c': 99999999, 'a': ''} AS s2, {'c': 99999999, 'a': ''} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {'c': s0.c + 2, 'a': s0.a || 'D'},
    list_min([{'c': n1.c + 2, 'a': n1.a || 'D'}, {'c': CASE WHEN free AND r = 's' THEN s0.c + more ELSE 99999999 END, 'a': s0.a || 'K'}]),
    list_min([{'c': n2.c + 2, 'a': n2.a || 'D'}]
      || list_transform([s0, n1, n3], lambda x: {'c': CASE WHEN free AND r = 'u' THEN x.c + more ELSE 99999999 END, 'a': x.a || 'K'})
      || list_transform([s0, n1, n3], lambda x: {'c': CASE WHEN free THEN x.c + more + 1 ELSE 99999999 END, 'a': x.a || 'R'})),
    list_min([{'c': n3.c + 2, 'a': n3.a || 'D'}, {'c': CASE WHEN free AND r = 'a' THEN n2.c + more ELSE 99999999 END, 'a': n2.a || 'K'},
              {'c': CASE WHEN free THEN n2.c + more + 1 ELSE 99999999 END, 'a': n2.a || 'R'}])
  FROM (
    SELECT *, list_min([s3, {'c': n2.c + 5, 'a': n2.a || 'I'}]) AS n3 FROM (
      SELECT search.conv_id, row_.i, r, fault NOT IN ('blank', 'duplicate') AS free, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more, s0, s1 AS n1, s3,
             list_min([s2, {'c': s0.c + 5, 'a': s0.a || 'I'}, {'c': s1.c + 5, 'a': s1.a || 'I'}, {'c': s3.c + 5, 'a': s3.a || 'I'}]) AS n2
      FROM search JOIN row_ ON row_.conv_id IS NOT DISTINCT FROM search.conv_id AND row_.i = search.i + 1
    )
  )
),
best AS (
  SELECT conv_id, list_min([s0, s3, {'c': s1.c + 10, 'a': s1.a || 'II'}, {'c': s2.c + 5, 'a': s2.a || 'I'}]) AS b
  FROM (SELECT * FROM search QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
),
letter AS (SELECT conv_id, k, b.a[k] AS x FROM (SELECT conv_id, b, unnest(generate_series(1, length(b.a))) AS k FROM best)),
edit AS (
  SELECT *, count(*) FILTER (x != 'I') OVER w AS i, count(*) FILTER (x != 'D') OVER w AS e
  FROM letter WINDOW w AS (PARTITION BY conv_id ORDER BY k)
),
applied AS (
  SELECT edit.conv_id, k, x, e, role, text, coalesce(max(CASE WHEN e = 1 AND x = 'K' AND r = 's' THEN 1 END) OVER (PARTITION BY edit.conv_id), 0) AS s
  FROM edit LEFT JOIN row_ ON row_.conv_id IS NOT DISTINCT FROM edit.conv_id AND row_.i = edit.i AND x != 'I'
),
said AS (
  SELECT conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN (e - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS t
  FROM applied WHERE x != 'D' GROUP BY conv_id
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM row_ GROUP BY conv_id
)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM best.conv_id
"""

CHECKS: dict[str, str] = {
    "op1_ngram_jaccard_join": _OP1,
    "op3_substring_dedup": _OP3,
    "op4_chat_format": _OP4,
    "op7_decontamination": _OP7,
    "op11_license_scan": _op11(),
    "op12_centroid_clustering": _op12(),
    "op13_turn_repair": _OP13,
}
