"""The registered queries of the operators and the SQL they are checked with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.llm.common import table
from fleetrisk.llm.decontaminate import find_contamination
from fleetrisk.llm.divergence import divergence
from fleetrisk.llm.hard_negatives import hard_negatives
from fleetrisk.llm.lines import dedup_lines
from fleetrisk.llm.packing import pack
from fleetrisk.llm.quality import quality_rules
from fleetrisk.llm.quality_model import quality
from fleetrisk.llm.quality_model import train as train_quality
from fleetrisk.llm.secrets import KINDS, find_secrets, listed
from fleetrisk.llm.sharding import shard
from fleetrisk.llm.simhash import near_duplicates
from fleetrisk.llm.tokens import count_tokens
from fleetrisk.llm.toxicity import toxicity, train
from fleetrisk.llm.warc import read_warc, write_warc
from fleetrisk.session import scratch_path

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op9_line_dedup", f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM parts),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {STRIP})")} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
FROM (SELECT *, key IN (SELECT key FROM frequent) AS goes FROM keyed) AS k GROUP BY doc_id""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are removed everywhere."""
    docs = dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_quality_rules", f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS words FROM documents),
words AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM docs),
windows AS (
  SELECT doc_id, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS gram FROM words
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows WHERE gram IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM repeated, range(3) AS r(d) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, {LOWER.format(f"trim(line, {STRIP})")} AS key,
    len(list_filter(string_split_regex(line, '[ \\t-\\r]+'), lambda w: w <> '')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)),
worded AS (SELECT * FROM lines WHERE n > 0),
frequent AS (
  SELECT source, key FROM worded GROUP BY source, key HAVING count(DISTINCT doc_id) > 10),
lost AS (
  SELECT doc_id, sum(n) AS lost FROM worded JOIN frequent USING (source, key) GROUP BY doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
base AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, cast(coalesce(lost, 0) AS bigint) AS n_lost_words
  FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, base_failed = false AND n_lost_words <= (1 - 0.3e0) * n_words AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)""")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text, and documents that fail them or lose their words to boilerplate of their source."""
    return quality_rules(table(spark, sf_dir, "documents")).drop("depleted", "clean_text")


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passwords, access keys, hexadecimal keys and strings of high entropy, by place."""
    docs = find_secrets(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return docs.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
                       F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
                       listed(F.col("secret_spans")).alias("spans"))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles, linked at four differing bits or fewer."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text; the cache is a new one for each call, so that each distinct text is encoded once."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token_cache"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes, equal texts side by side."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("_text"))
    out = shard(docs, 8, F.col("size"), F.col("_text"), F.xxhash64("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op8_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
d AS (SELECT *, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payloads=False).drop("url", "payload")


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, with up to a tenth of their characters edited."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def held_out(id_: str) -> Column:
    return F.crc32(F.col(id_).cast("string").cast("binary")) % 3 == 1


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by a model of the labels of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in words, packed into sequences of 512 to 4096."""
    return pack(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256e0 * cast(x AS double))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
s AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, cast(list_inner_product(a.x, b.x) AS bigint) AS score
  FROM v AS a JOIN v AS b ON a.id <> b.id WHERE a.id % 100 = 0),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT pos.anchor_id, positive_id,
  cast(row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, other) AS integer) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s ON s.anchor_id = pos.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector its nearest rows of the same label and, below each of them, those of other labels."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query("op11_source_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (
  SELECT doc, lang, source, """ + LOWER.format("term") + r""" AS term FROM (SELECT doc, lang, source, unnest(terms) AS term FROM d)),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, cast(coalesce(sum(c), 0) AS hugeint) AS n, cast(coalesce(any_value(v), 0) AS hugeint) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c, 1 + (cast(1000000000 AS hugeint) * (coalesce(c, 0) + 2)) // (n + 2 * v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
l AS (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang),
q AS (
  SELECT lang, term, any_value(1 + (cast(1000000000 AS hugeint) * (total + 2)) // (n + 2 * v)) AS q
  FROM (SELECT lang, term, sum(c) AS total FROM p GROUP BY lang, term) JOIN l USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
telling AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, cast(value AS bigint) AS value,
  cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS integer) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM telling) QUALIFY part = 'pair' OR rank <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the terms of each source are from those of the others and of its language."""
    return divergence(table(spark, sf_dir, "documents"))


@query("op12_quality_model")
def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by a model of the labels of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), quality(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
