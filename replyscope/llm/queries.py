"""One query per corpus operator, and the corpus pipeline, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from replyscope.llm import (
    conversation_trie, embedding, language_id, lexical_search, line_dedup, minhash, mixing, packing, quality_classifier, quality_rules, substring,
    token_counts, warc,
)
from replyscope.llm.common import documents, read_table, remainder


def op1_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    model = language_id.train(docs.filter("NOT held_out"))
    return language_id.identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    # kept words are joined by one space; a text that nothing was removed from is too
    words = F.coalesce("text", F.lit("")).cast("binary")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.archive(read_table(spark, sf_dir, "pages")).select(*columns)


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(docs.select("doc_id", "lang", "text"), quality_rules.references(docs)).select(*columns)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept_back = remainder("doc_id", 3) == 1
    model = quality_classifier.train(docs, quality_classifier.learnable(read_table(spark, sf_dir, "labels"), kept_back))
    scored = quality_classifier.score(docs.withColumn("held_out", kept_back), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turns_of(read_table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.regrown(turns)).drop("a", "b")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source
), often AS (
  SELECT source, line FROM lines JOIN pages USING (source)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY source, line, pages HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) > 0.1 * pages
), marked AS (
  SELECT l.doc_id, l.line, l.i, o.line IS NOT NULL AS bad FROM lines l LEFT JOIN often o ON l.source = o.source AND l.line = o.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '') AS text
FROM marked GROUP BY doc_id
"""

TRIE_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS at,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv, count(*) AS own, conv - ((conv % 100) + 100) % 100 AS stem,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) % 6 AS h
  FROM turns GROUP BY conv
), sized AS (
  SELECT c.*, least(c.h, coalesce(s.own, 0)) AS have FROM convs c LEFT JOIN convs s ON c.stem = s.conv
), rows AS (
  SELECT c.conv, t.at + 1 AS depth, t.turn, t.size FROM sized c JOIN turns t ON t.conv = c.stem AND t.at < c.have
  UNION ALL SELECT c.conv, c.have + t.at - c.h + 1, t.turn, t.size FROM sized c JOIN turns t ON t.conv = c.conv AND t.at >= c.h
  UNION ALL SELECT conv, 0, 'root', 0 FROM convs
), paths AS (
  SELECT conv, depth, size, string_agg(turn, ',') OVER (PARTITION BY conv ORDER BY depth) AS node, lag(1) OVER (PARTITION BY conv ORDER BY depth DESC) IS NULL AS ends FROM rows
), parents AS (
  SELECT *, lag(node) OVER (PARTITION BY conv ORDER BY depth) AS parent FROM paths
), nodes AS (
  SELECT node, any_value(parent) AS parent, depth, min(conv) AS conv, count(*) AS members, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256
  FROM parents GROUP BY node, depth
), children AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent
), under AS (
  SELECT p.node, sum(n.saved)::BIGINT AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM parents p JOIN nodes n ON n.conv = p.conv AND n.depth >= p.depth LEFT JOIN children c ON c.parent = n.node
  GROUP BY p.node
)
SELECT n.conv AS conv_id, n.depth, p.conv AS parent_conv_id, n.members AS n_convs, coalesce(c.n, 0) AS n_children, u.leaves AS n_leaves,
  u.saved AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under u ON u.node = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.parent = n.node
"""

SEARCH_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
), tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term
), scores AS (
  SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), total GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: name -> (query, SQL for DuckDB or None)
ENTRIES = {
    "op1_hyperminhash": (op1_hyperminhash, None),
    "op2_line_dedup": (op2_line_dedup, LINE_DEDUP_SQL),
    "op3_packing": (op3_packing, None),
    "op4_mixing": (op4_mixing, None),
    "op5_language_id": (op5_language_id, None),
    "op6_substring_dedup": (op6_substring_dedup, None),
    "op7_warc": (op7_warc, None),
    "op8_nn_descent": (op8_nn_descent, None),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_quality_classifier": (op10_quality_classifier, None),
    "op11_burst_trie": (op11_burst_trie, TRIE_SQL),
    "op12_token_counts": (op12_token_counts, None),
    "op13_lexical_search": (op13_lexical_search, SEARCH_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
