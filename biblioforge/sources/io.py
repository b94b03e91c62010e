"""Readers and writers: JSON Lines, CSV, headed Markdown, state tables and retained backups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioforge.functions.text import json_value
from biblioforge.store import keep


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found and len(found))


def parse_json_lines(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines) of a `value` column; blank lines are skipped. Other columns travel along."""
    rows = lines.where(F.trim("value") != "").withColumn("_r", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    rest = [c for c in lines.columns if c != "value"]
    good = rows.where("_r is not null and _r._bad is null").select(*rest, "_r.*").drop("_bad")
    return good, rows.where("_r is null or _r._bad is not null").select(*rest, "value")


def read_json_lines(spark: SparkSession, path: str, schema: str, glob: str | None = None) -> DataFrame:
    """Tolerant scan of a file or folder: malformed lines are dropped, a missing path is empty. Adds _src, the file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema + ", _src string")
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return parse_json_lines(reader.text(path).withColumn("_src", F.col("_metadata.file_path")), schema)[0]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """_src, line (from 1, blank lines count), value.

    A file is read in its splits. Lines are counted per split, and prefix sums of the counts (a row a split) give each
    line its number in the file; no task holds a file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_src"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_i"), "value")
    splits = lines.groupBy("_src", "_start").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_src").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = keep(splits.select("_src", "_start", "_first", before.alias("_before")), "splits")
    return lines.join(splits, ["_src", "_start"]).select("_src", (F.col("_i") - F.col("_first") + F.col("_before") + 1).alias("line"), "value")


def is_malformed(value: str) -> Column:
    """Whether a line holds text but no JSON."""
    return (F.trim(value) != "") & json_value(value).isNull()


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Those of numbered lines that hold text but no JSON."""
    return lines.where(is_malformed("value"))


def read_json_lines_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """_src, line and the record of each line with text. The first malformed line (by file, then line) is an error that names it."""
    lines = numbered_lines(spark, path)
    bad = malformed_lines(lines).orderBy("_src", "line").limit(1).collect()
    if bad:
        raise ValueError(f"malformed line {bad[0].line} of {bad[0]['_src']}: {bad[0].value[:80]}")
    return lines.where(F.trim("value") != "").select("_src", "line", F.from_json("value", schema).alias("_r")).select("_src", "line", "_r.*")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per line, null fields left out. mode 'append' is the log sink."""
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Report sink: one file with a header; for aggregates, not for tables that grow."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def parse_headed_markdown(lines: DataFrame, order: str = "line", by: str = "_src") -> DataFrame:
    """Topic records of `## n. JA (EN)`, `### n-m. JA (EN)` and `- **topic (en):** a, b` lines; headers carry forward within a file.

    A new segment header resets the subsegment.
    """
    seg, sub, item = r"^##\s+(\d+)\.\s*(.+?)\s*\((.+)\)\s*$", r"^###\s+(\d+-\d+)\.\s*(.+?)\s*\((.+)\)\s*$", r"^-\s+\*\*(.+?)\s*\((.+?)\)[:：]\*\*\s*(.*)$"
    part = lambda p, i: F.nullif(F.regexp_extract("value", p, i), F.lit(""))
    head = lambda p: F.when(F.col("value").rlike(p), F.struct(part(p, 1).alias("num"), part(p, 2).alias("ja"), part(p, 3).alias("en")))
    w = Window.partitionBy(by).orderBy(order)
    rows = lines.withColumn("_seg", head(seg)).withColumn("_sub", head(sub))
    rows = rows.withColumn("s", F.last("_seg", True).over(w)).withColumn("_n", F.count("_seg").over(w))
    rows = rows.withColumn("b", F.last("_sub", True).over(Window.partitionBy(by, "_n").orderBy(order))).where(F.col("value").rlike(item))
    from biblioforge.functions.text import split_keywords

    words = split_keywords(part(item, 3))
    return rows.select(
        by, order, F.col("s.num").cast("int").alias("segment_num"), F.col("b.num").alias("subsegment_num"), F.col("s.en").alias("segment"), F.col("s.ja").alias("segment_ja"),
        F.col("b.en").alias("subsegment"), F.col("b.ja").alias("subsegment_ja"), part(item, 1).alias("topic"), part(item, 2).alias("topic_en"), words["ja"].alias("keywords_ja"), words["en"].alias("keywords_en"),
    )


def pending(work: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Rows of work whose key the state table doesn't hold."""
    return work.join(state.select(key).distinct(), key, "left_anti")


def expired_backups(names: DataFrame, keep: int = 10, by: list[str] | None = None) -> DataFrame:
    """Backup names beyond the newest `keep`, by name; per `by` where given."""
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.desc("name"))
    return names.withColumn("rank", F.row_number().over(w)).where(F.col("rank") > keep).drop("rank")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Relational projection: one Parquet folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
