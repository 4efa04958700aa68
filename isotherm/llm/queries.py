"""The operators as registered queries over whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import byte_bpe, chat, exact_dedup, language, lines, near_dedup, packing, phrases, quality, recompression, repeats, topk, trie
from isotherm.llm.frames import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.chat_digests(chat.join_segments(chat.format_chats(turns)))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"))
    network = language.train(docs.where(~out))
    return language.identify(docs, network).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").where(~out).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.train(docs, labels))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", out.alias("held_out"), "score", predicted)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = recompression.cut_later(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_byte_bpe,
        op3_minhash_near_dedup,
        op4_line_dedup,
        op5_best_fit_packing,
        op6_language_id,
        op7_suffix_array_dedup,
        op8_quality_classifier,
        op9_exact_top_k,
        op10_exact_dedup,
        op11_conversation_trie,
        op12_substring_dedup,
        op13_phrase_collocations,
    )
}

ORACLE = {
    "op4_line_dedup": """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
    string_split(translate(parts[line_no + 1], chr(9) || chr(13), '  '), ' '), lambda w: w <> ''))) AS words
  FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS line_no FROM docs)
), sets AS (
  SELECT words, len(words) AS n, row_number() OVER (ORDER BY min((doc_id, line_no))) AS node, min((doc_id, line_no)) AS first
  FROM lines WHERE len(words) > 0 GROUP BY words
), entries AS (SELECT node, n, unnest(words) AS word FROM sets),
common AS (
  SELECT b.node AS node, count(*) AS same, any_value(a.n) AS n_a, any_value(b.n) AS n_b
  FROM entries b JOIN entries a ON a.word = b.word AND a.node < b.node AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY b.node, a.node
), near AS (SELECT DISTINCT node FROM common WHERE 5 * same >= 4 * (n_a + n_b - same)),
gone AS (
  SELECT l.doc_id, l.line_no, (l.doc_id, l.line_no) = s.first AS is_first
  FROM lines l JOIN sets s ON s.words = l.words LEFT JOIN near USING (node)
  WHERE near.node IS NOT NULL OR (l.doc_id, l.line_no) <> s.first
), per_doc AS (SELECT doc_id, list(line_no) AS places, count(*) AS n, count(*) FILTER (WHERE is_first) AS n_near FROM gone GROUP BY doc_id)
SELECT doc_id,
  CAST(len(parts) AS BIGINT) AS n_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  sha256(coalesce(array_to_string(list_filter(parts, lambda p, i: NOT list_contains(coalesce(places, []), i - 1)), chr(10)), '')) AS kept_sha256
FROM docs LEFT JOIN per_doc USING (doc_id)
""",
    "op9_exact_top_k": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score
  FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
""",
    "op10_exact_dedup": """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op12_substring_dedup": r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), starts AS (SELECT doc_id, words, unnest(range(greatest(len(words) - 19, 0))) AS s FROM docs),
windows AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s + 1:s + 20], ' ') ORDER BY doc_id, s) AS nth FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM windows WHERE nth > 1),
per_doc AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT doc_id,
  CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_filter(words, lambda w, i: NOT list_contains(coalesce(places, []), i - 1)), ' '), '')) AS kept_sha256
FROM docs LEFT JOIN per_doc USING (doc_id)
""",
    "op13_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
sized AS (SELECT lang, ws, unnest([1, 2, 3]) AS k FROM lists),
placed AS (SELECT lang, ws, k, unnest(range(greatest(len(ws) - k + 1, 0))) AS i FROM sized),
f AS (SELECT lang, k, ws[i + 1:i + k] AS phrase, count(*) AS f FROM placed GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r,
    CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = c.phrase[1:cut]
  JOIN f y ON y.lang = c.lang AND y.phrase = c.phrase[cut + 1:]
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
shadows AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, unnest([phrase[1:2], phrase[2:3]]) AS part FROM candidates WHERE k = 3) GROUP BY lang, part
), kept AS (
  SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN shadows s ON s.lang = b.lang AND s.part = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * b.a
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank" FROM kept)
SELECT lang, "rank", phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE "rank" <= 2000
""",
}
