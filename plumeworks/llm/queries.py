"""The registered queries of this package: production parameters over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, contain, jaccard, negatives, packing, pages, pii, secret_scan, suffix, syncmers, topk, toxicity, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(table(spark, sf, "documents"))


@query
def op2_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


ORACLES["op2_topk"] = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op3_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf, "documents"))


ORACLES["op3_repeats"] = suffix.ORACLE


@query
def op4_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract(table(spark, sf, "pages"))


@query
def op5_chats(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_chats(table(spark, sf, "conversations"))


ORACLES["op5_chats"] = chat.ORACLE


@query
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contain.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op6_decontamination"] = contain.ORACLE


@query
def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf, "documents"))


@query
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.link(table(spark, sf, "documents"))


ORACLES["op10_jaccard"] = jaccard.ORACLE


@query
def op11_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf, "conversations"))


ORACLES["op11_trie"] = trie.ORACLE


@query
def op12_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("label")
    vectors = table(spark, sf, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(vectors)


ORACLES["op12_negatives"] = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query
def op13_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.fingerprint_documents(table(spark, sf, "documents"))
