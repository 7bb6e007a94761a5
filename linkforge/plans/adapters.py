"""Views of the test tables as entities: id, name, address, country and a numeric ``rid``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import halves
from ..operators.truth import KeyTruth


def _entity(k):
    return F.concat(F.lit("S"), (F.lit(1) + k % 3).cast("string"), F.lit("-"), k.cast("string"))


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    return p.select(
        _entity(k).alias("entity_id"), F.col("p_name").alias("business_name"),
        F.when(k % 37 == 0, "").otherwise(F.concat_ws(" ", F.col("p_size").cast("string"), "p_brand", "p_type")).alias("business_address"),
        F.lower("p_type").alias("country"), k.alias("rid"), F.concat_ws("|", "p_name", "p_brand").alias("truth_key"))


def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with all their tokens: the first half is the name, the second the address."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    t = d.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("truth_key"), halves(F.col("text")).alias("t"))
    return t.select(
        _entity(F.col("doc_id")).alias("entity_id"), F.col("t.name").alias("business_name"), F.col("t.address").alias("business_address"),
        F.col("lang").alias("country"), F.col("doc_id").alias("rid"), "truth_key")


def party_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as source 1 and suppliers as source 2, without addresses."""
    nation = F.broadcast(spark.read.parquet(f"{sf_dir}/nation.parquet"))  # 25 rows
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    row = lambda df, tag, key, name: df.select(F.concat(F.lit(tag), F.col(key).cast("string")).alias("entity_id"), F.col(name).alias("business_name"), F.lit("").alias("business_address"), F.col("n_name").alias("country"), F.col(key).alias("rid"))
    return row(c, "S1-", "c_custkey", "c_name").unionByName(row(s, "S2-", "s_suppkey", "s_name"))


def sides(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source 1, targets)."""
    one = F.col("entity_id").startswith("S1-")
    return entities.where(one), entities.where(~one)


def links_of(entities: DataFrame) -> KeyTruth:
    """Links of equal truth keys."""
    q, t = sides(entities)
    return KeyTruth(*[df.select(F.col("entity_id").alias(c), F.col("truth_key").alias("key")) for df, c in ((q, "q_id"), (t, "t_id"))])


def truth_of(entities: DataFrame) -> DataFrame:
    """(q_id, t_id) of equal truth keys."""
    return links_of(entities).links()
