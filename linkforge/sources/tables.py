"""Sources and sinks: checked TSV scans, id lists, reports, the written index."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]
EVIDENCE = ["source1_entity_id", "candidate_view_masks"]
MATCHES = TRUTH


def header_of(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).first()
    return first[0].rstrip("\r\n").split("\t") if first else []


def read_tsv(spark: SparkSession, path: str, columns: list[str], check: bool = True, lines: bool = False) -> DataFrame:
    """Tab-separated strings with ``""`` quoting; the header must be exactly ``columns``. Empty
    fields are empty strings, blanks around values stay. With ``lines`` quoted values may hold line
    breaks; a file is then one task, while otherwise large files are split."""
    if check and (found := header_of(spark, path)) != columns:
        raise ValueError(f"{path}: header {found}, expected {columns}")
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', multiLine=lines, enforceSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def read_any(spark: SparkSession, path: str, limit: int | None = 200_000) -> DataFrame:
    """csv, tsv or parquet by suffix; a profile reads the first rows only."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind in ("csv", "tsv"):
        df = spark.read.options(sep="\t" if kind == "tsv" else ",", header=True, quote='"', escape='"', multiLine=True, inferSchema=True).csv(path)
    else:
        raise ValueError(f"no reader for {path}")
    return df.limit(limit) if limit else df


def find_tables(spark: SparkSession, root: str) -> list[str]:
    """All .csv, .tsv and .parquet below a folder of any Hadoop file system, sorted."""
    sc = spark.sparkContext
    base = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs, out, todo = base.getFileSystem(sc._jsc.hadoopConfiguration()), [], [base]
    while todo:
        for s in fs.listStatus(todo.pop()):
            name = s.getPath().toString()
            if name.lower().endswith((".csv", ".tsv", ".parquet")):
                out.append(name)
            elif s.isDirectory():
                todo.append(s.getPath())
    return sorted(out)


def union_targets(source2: DataFrame, source3: DataFrame) -> DataFrame:
    """Source 2 rows, then source 3 rows, with the order that ties go by."""
    return source2.withColumn("src_ord", F.lit(2)).unionByName(source3.withColumn("src_ord", F.lit(3)))


def id_list(c):
    """Comma list to an array of distinct ids without empty ones."""
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != ""))


def truth_lists(truth: DataFrame) -> DataFrame:
    return truth.select(F.col("source1_entity_id").alias("q_id"), id_list(F.col("matched_entity_ids")).alias("ids"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth_lists(truth).select("q_id", F.explode("ids").alias("t_id"))


def load_truth(truth: DataFrame, ids: DataFrame, complete: bool = True) -> DataFrame:
    """Truth lists of the given q_ids; each must have a row if ``complete``."""
    kept = truth_lists(truth).join(ids.select("q_id"), "q_id", "left_semi")
    if complete and (n := ids.select("q_id").distinct().join(kept, "q_id", "left_anti").count()):
        raise ValueError(f"{n} entities have no truth row")
    return kept


def candidate_pairs(lists: DataFrame) -> DataFrame:
    """Candidate lists to (q_id, t_id, rank, total)."""
    ids = F.filter(F.split(F.coalesce("candidate_entity_ids", F.lit("")), ","), lambda x: x != "")
    a = lists.select(F.col("source1_entity_id").alias("q_id"), ids.alias("ids"))
    return a.select("q_id", F.size("ids").alias("total"), F.posexplode("ids").alias("pos", "t_id")).select("q_id", "t_id", (F.col("pos") + 1).alias("rank"), "total")


def match_lists(entities: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per entity in the output's form, an empty list where nothing matched."""
    best = matches.groupBy("q_id", "t_id").agg(F.min("rank").alias("rank"))
    lists = best.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("rank", "t_id"))).alias("l"))
    return entities.select("q_id").join(lists, "q_id", "left").select(
        F.col("q_id").alias("source1_entity_id"), F.coalesce(F.array_join(F.transform("l", lambda x: x["t_id"]), ","), F.lit("")).alias("matched_entity_ids"))


def write_tsv(df: DataFrame, path: str, ordered_by: str | None = None, mode: str = "errorifexists") -> None:
    """Tab-separated with a header; ``.gz`` compresses. With ``ordered_by`` the parts follow that
    order, so that they can be concatenated."""
    if ordered_by:
        df = df.orderBy(ordered_by)
    opts = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}
    if path.endswith(".gz"):
        opts["compression"] = "gzip"
    df.write.mode(mode).options(**opts).csv(path)


def write_index(targets: DataFrame, path: str, expected: int | None = None) -> int:
    """Keyed targets, sorted by id within files, and their postings sorted by key; refuses to
    overwrite. Returns the number of targets, which must be ``expected`` if given."""
    targets.write.mode("errorifexists").parquet(f"{path}/targets")
    spark = targets.sparkSession
    n = spark.read.parquet(f"{path}/targets").count()
    if expected is not None and n != expected:
        raise ValueError(f"{n} targets, expected {expected}")
    posts = spark.read.parquet(f"{path}/targets").select("t_id", F.explode("keys").alias("key"))
    posts.repartition("key").sortWithinPartitions("key", "t_id").write.mode("errorifexists").parquet(f"{path}/postings")
    return n


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/targets")


def write_json(found, path: str) -> None:
    """A report (a one-row frame, or anything JSON has a form for) as a document in any Hadoop file system."""
    spark = SparkSession.getActiveSession()
    if isinstance(found, DataFrame):
        found = found.first().asDict(recursive=True)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(found, indent=2, sort_keys=True, default=str).encode()))
    out.close()
