"""One query per operator over the whole of its table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import (
    boundary_bpe,
    fingerprints,
    language_id,
    line_dedup,
    lm_score,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    sharding,
    spelling,
    token_files,
)
from duebook.llm.rows import documents, in_fold, pinned, prepare
from duebook.session import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixing.mixed_order(docs, mixing.tempered_weights(docs))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.with_bitmaps(documents(spark, sf_dir))
    kept = F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(line_dedup.kept_text("text", "bitmap"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


ORACLES["op2_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(documents(spark, sf_dir), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.where(~in_fold("doc_id", 5)))
    found = language_id.identify(docs, model)
    return found.select("doc_id", in_fold("doc_id", 5).alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = lm_score.scores(docs, docs.where(~in_fold("doc_id", 10)))
    return found.withColumn("held_out", in_fold("doc_id", 10))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = pinned(quality.rule_statistics(documents(spark, sf_dir), "doc_id"))
    model = quality.fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(stats, model).select("doc_id", *quality.BASE, "base_failed", "kept", "score")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack_documents(documents(spark, sf_dir), str(tokenizer), end_id=1, with_ids=False)
    return pieces.drop("ids")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, sf_dir), shards=8)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(documents(spark, sf_dir))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(documents(spark, sf_dir), folder, str(tokenizer), end_id=0, vocabulary=50_257)
    return token_files.read_token_files(spark, folder, with_ids=False)


@query
def op11_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    coded = boundary_bpe.round_trip(documents(spark, sf_dir), str(tokenizer))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variant_forms(documents(spark, sf_dir))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: crc32 of a text, bit by bit: each byte is followed by eight marks for one shift each.
_CRC_SQL = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split({text}, ''),
      lambda c: [unicode(c), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda s, v: CASE WHEN v >= 0 THEN xor(s, v)
      WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END), 4294967295)"""

ORACLES["op13_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS leader, h % 6 AS h FROM (
    SELECT conv_id, {_CRC_SQL.format(text="conv_id::VARCHAR")} AS h FROM (SELECT DISTINCT conv_id FROM turns))
), built AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM (
    SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.leader AND place <= h
    UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h)
), prefixes AS (
  SELECT conv_id, depth, length(text) AS points,
    string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), keyed AS (
  SELECT conv_id, depth, points, sha256(node) AS node, lag(sha256(node)) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
    depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(points) AS points, min(conv_id) AS conv_id,
    count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM keyed GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node
), under AS (
  SELECT DISTINCT up.node AS top, down.node AS node FROM keyed up JOIN keyed down ON up.conv_id = down.conv_id AND up.depth <= down.depth
), sums AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * points)::BIGINT AS saved_tokens
  FROM under JOIN valued ON under.node = valued.node GROUP BY top
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM valued v JOIN sums ON sums.top = v.node LEFT JOIN valued p ON p.node = v.parent
"""

ORACLES["op12_spelling_variants"] = f"""
WITH runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
  SELECT run, length(run) AS size, doc_id, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT *, doc_id::VARCHAR || ':' || array_to_string(list_transform(string_split(run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN c ELSE chr(192 + unicode(c) // 64 % 4) || chr(128 + unicode(c) % 64) END), '') AS raw
  FROM counted
), hashed AS (
  SELECT run, size, n, {_CRC_SQL.format(text="raw")} AS h FROM bytes
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % size)::INT) || substr(run, (h % size)::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS (
  SELECT word, n, left(word, i) || '?' || substr(word, i + 2) AS hole, left(word, i) || substr(word, i + 2) AS shorter
  FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.shorter
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.shorter
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, min(p.other) AS form, min(p.n) AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
  LEFT JOIN pairs p ON p.word = w.word AND p.n = b.form_n AND p.n >= 10 * w.n GROUP BY ALL
), chains AS (
  WITH RECURSIVE steps AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next
  ) SELECT word, root FROM steps WHERE next IS NULL
)
SELECT f.word, n, n_near, form, form_n, root FROM forms f JOIN chains c ON c.word = f.word
"""
