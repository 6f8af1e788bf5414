"""The registered queries of the operators, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.llm import (
    decontam,
    license_scan,
    line_chunks,
    line_quality,
    merkle,
    order_minhash,
    packing,
    passage_quality,
    sharding,
    suffix_dedup,
    token_count,
    toxicity,
    whitening,
)
from callmill.llm.common import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.line_dedup(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_lines",
    )


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = toxicity.in_test_fold(F.col("doc_id"))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_clauses")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "representative"
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = passage_quality.train(docs, table(spark, sf_dir, "labels"))
    held_out = toxicity.in_test_fold(F.col("doc_id"))
    return passage_quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "n_passages", "top_passage"
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_line_dedup,
        op3_best_fit_packing,
        op4_benchmark_decontamination,
        op5_quality_rules,
        op6_license_scans,
        op7_toxicity,
        op8_sharding,
        op9_minhash_near_dedup,
        op10_token_counts,
        op11_quality_classifier,
        op12_merkle_manifest,
        op13_embedding_whitening,
    )
}

_OP4 = r"""
WITH words AS (
  SELECT 'd' AS side, CAST(doc_id AS VARCHAR) AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR),
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT id AS item, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS window_words
  FROM words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE side = 'b' AND len(w) > 0
), lengths AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT id, k, i, array_to_string(w[i:i + k - 1], ' ') AS window_words
  FROM words, lengths, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE side = 'd'
), found AS (
  SELECT d.id, d.i, d.k, b.item FROM doc_windows d JOIN item_windows b ON d.k = b.k AND d.window_words = b.window_words
), hit AS (
  SELECT id, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(0, k)) AS t(j) GROUP BY id
), items AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM found GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM documents JOIN words ON side = 'd' AND words.id = CAST(doc_id AS VARCHAR)
LEFT JOIN hit ON hit.id = words.id LEFT JOIN items ON items.id = words.id
"""

_OP5 = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM base, unnest(range(1, len(w) - 6)) AS t(i)
), repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows
  ), unnest(range(0, 8)) AS t(j) WHERE n > 1 GROUP BY doc_id
), plain AS (
  SELECT doc_id, source, text, length(regexp_replace(line, '[ \t\n\x0B\f\r]+', '', 'g')) AS chars,
    regexp_replace(trim(regexp_replace(lower(line), '[ \t\n\x0B\f\r]+', ' ', 'g')), '[0-9]', '0', 'g') AS line
  FROM base, unnest(lines) AS t(line)
), hosts AS (
  SELECT source, count(DISTINCT text) AS n FROM base GROUP BY source
), frequent AS (
  SELECT p.source, p.line FROM plain p JOIN hosts h ON p.source IS NOT DISTINCT FROM h.source
  GROUP BY p.source, p.line, h.n HAVING
    count(DISTINCT p.text) >= 5 AND 100 * count(DISTINCT p.text) > 5 * h.n OR count(DISTINCT p.text) > 10000
), cut AS (
  SELECT doc_id, count(*) AS n, sum(chars) AS chars
  FROM plain p JOIN frequent f ON p.source IS NOT DISTINCT FROM f.source AND p.line = f.line GROUP BY doc_id
), stats AS (
  SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(b.text, '[ \t\n\x0B\f\r]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(b.text) - length(regexp_replace(b.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(c.chars, 0) AS BIGINT) AS removed_chars
  FROM base b LEFT JOIN repeated r ON b.doc_id = r.doc_id LEFT JOIN cut c ON b.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT 100 * (word_chars - removed_chars) < 50 * word_chars AS kept,
  n_removed_lines
FROM stats
"""


def _op6() -> str:
    """Containment of every template in every window that can hold it, without bands."""
    rows = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in license_scan.TEMPLATES)
    split = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return f"""
WITH templates AS (SELECT name, {split.format('t')} AS w FROM (VALUES {rows}) AS v(name, t)),
shingled AS (
  SELECT DISTINCT name, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM templates, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i)
), sized AS (SELECT *, count(*) OVER (PARTITION BY name) AS size FROM shingled),
docs AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
ks AS (SELECT DISTINCT k FROM sized),
places AS (
  SELECT doc_id, k, i - 1 AS i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM docs, ks, unnest(range(1, len(w) - k + 2)) AS u(i)
), found AS (
  SELECT DISTINCT doc_id, name FROM (
    SELECT doc_id, name, size, (i // size + d) AS part, s FROM places JOIN sized USING (k, s), unnest([0, -1]) AS u(d)
  ) GROUP BY doc_id, name, size, part HAVING 100 * count(DISTINCT s) >= 80 * size
)
SELECT doc_id, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses, count(name) AS n_licenses
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


_OP12 = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, text, coalesce(CAST(doc_id AS VARCHAR), '') AS digits,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM documents
), checked AS (
  SELECT *, xor(4294967295, list_reduce(
      flatten(list_transform(string_split(digits, ''), lambda c:
        CASE WHEN c = '' THEN CAST([] AS BIGINT[]) ELSE [ord(c), -1, -1, -1, -1, -1, -1, -1, -1] END)),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
        WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(4294967295 AS BIGINT))) AS crc
  FROM fields
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS now
  FROM checked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
), built AS (
  SELECT tree, 0 AS height, idx, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, height + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM built) WHERE n > 1 GROUP BY tree, height, idx // 8
), subroots AS (
  SELECT tree, max(height) AS height, arg_max(digest, height) AS subroot FROM built GROUP BY tree
), topped AS (
  SELECT 0 AS height, row_number() OVER (ORDER BY tree) - 1 AS idx, subroot AS digest FROM subroots
  UNION ALL
  SELECT height + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM topped) WHERE n > 1 GROUP BY height, idx // 8
), every_node AS (
  SELECT b.tree, b.height, b.idx, b.digest, FALSE AS top FROM built b JOIN subroots s ON b.tree = s.tree AND b.height < s.height
  UNION ALL
  SELECT '', t.height, t.idx, t.digest, TRUE FROM topped t WHERE t.height < (SELECT max(height) FROM topped)
), siblings AS (
  SELECT a.tree, a.top, a.height, a.idx,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM every_node a JOIN every_node b
    ON a.tree = b.tree AND a.top = b.top AND a.height = b.height AND a.idx // 8 = b.idx // 8
  GROUP BY a.tree, a.top, a.height, a.idx
), climb AS (
  SELECT p.doc_id, p.leaf, p.tree AS lang_tree, p.tree, s.height = 0 AS top, 0 AS height,
    CASE WHEN s.height = 0 THEN k.idx ELSE p.idx END AS idx, p.now AS folded, '' AS proof, s.height AS high, k.idx AS rank
  FROM placed p JOIN subroots s ON p.tree = s.tree
  JOIN (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS idx FROM subroots) k ON p.tree = k.tree
  UNION ALL
  SELECT c.doc_id, c.leaf, c.lang_tree, c.tree, c.top OR c.height + 1 = c.high,
    CASE WHEN NOT c.top AND c.height + 1 = c.high THEN 0 ELSE c.height + 1 END,
    CASE WHEN NOT c.top AND c.height + 1 = c.high THEN c.rank ELSE c.idx // 8 END,
    sha256(s.l || c.folded || s.r), c.proof || s.l || s.r, c.high, c.rank
  FROM climb c JOIN siblings s ON c.top = s.top AND (c.top OR c.tree = s.tree) AND c.height = s.height AND c.idx = s.idx
), root AS (SELECT arg_max(digest, height) AS root, max(height) AS height FROM topped)
SELECT c.doc_id, c.leaf, s.subroot, r.root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
  c.folded = r.root AS verified
FROM climb c JOIN subroots s ON c.lang_tree = s.tree JOIN root r ON c.top AND c.height = r.height
"""


ORACLES = {
    "op4_benchmark_decontamination": _OP4,
    "op5_quality_rules": _OP5,
    "op6_license_scans": _op6(),
    "op12_merkle_manifest": _OP12,
}
