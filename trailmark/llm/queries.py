"""The thin queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import chat, decontam, html_main, langid, lm, packing, quality, simhash, topk, warc
from trailmark.llm.common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a double holds the floor of any double; null and non-finite components keep their vectors out
    scaled = F.transform("embedding", lambda x: F.expr("1024D") * x.cast("double"))
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**52, F.floor(F.when(F.abs(y) < 2.0**52, y)).cast("double")).otherwise(y))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("weights"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


#: A conversation that quotes the markers and escapes of common templates.
_TRICKY = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    row = lambda r: F.struct(F.lit(r[0]).cast("long").alias("conv_id"), F.lit(r[1]).cast("long").alias("turn"), F.lit(r[2]).alias("role"), F.lit(r[3]).alias("text"))
    extra = spark.range(1, numPartitions=1).select(F.inline(F.array(*map(row, _TRICKY))))
    read = chat.read_back(chat.format_chats(given.unionByName(extra)))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")), ["doc_id"])


#: The pages carry no date of their own.
CRAWL_DATE = "2020-01-01T00:00:00Z"


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derivatives(warc.responses(table(spark, sf_dir, "pages"), CRAWL_DATE))
    return out.withColumnRenamed("source_seq", "page_id").withColumns({"n_chars": F.char_length("block").cast("long"), "block_sha256": F.sha2("block", 256)}).drop("block")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs), ["doc_id"])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.measured(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_topk": op1_topk,
    "op2_main_text": op2_main_text,
    "op3_lm": op3_lm,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
}

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS4 = "regexp_extract_all(" + _ASCII_LOWER.format("coalesce(text, '')") + r", '[0-9a-z\x{80}-\x{10FFFF}]+')"

ORACLES = {
    "op1_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10""",
    "op4_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS4} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT doc_id, n, p, w[p:p + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item, spots.n AS n, p FROM spots JOIN win ON spots.n = win.n AND spots.g = win.g),
marks AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marks USING (doc_id) LEFT JOIN owners USING (doc_id)""",
    "op6_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
told AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    string_agg(role, ',' ORDER BY turn, role, text) || ',' AS roles,
    sum(16 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
      + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))) AS size
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(size AS BIGINT) AS formatted_chars,
  regexp_full_match(roles, '(system,)?(user,assistant,)+') AS valid
FROM told""",
}
