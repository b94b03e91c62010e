"""The master: works in versions, to which deliveries are added with deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge import schemas
from biblioforge.functions import text as T
from biblioforge.operators.matching import MEDIUM, greedy_merge, match_forms
from biblioforge.operators.model import convert_v1, merge_editions
from biblioforge.sources.versions import Snapshots
from biblioforge.store import keep, numbered_within

WORK_DDL = f"{schemas.BOOK_V2}, _ord long"


def read_records(spark: SparkSession, paths: list[str], stamp: str, convert: bool = True, glob: str | None = None) -> DataFrame:
    """Works (v2, with _file and _line) of JSON Lines files: nested ones as they are, flat ones converted or left out. Malformed lines are dropped."""
    from biblioforge.operators.model import union_all
    from biblioforge.sources.io import numbered_lines, parse_json_lines

    parts = []
    for number, path in enumerate(paths):
        lines = numbered_lines(spark, f"{path}/{glob}" if glob else path)
        lines = lines.select(F.concat(F.lit(f"{number:06d}:"), "_src").alias("_file"), F.col("line").alias("_line"), "value")
        nested = F.get_json_object("value", "$.editions").isNotNull()
        parts.append(parse_json_lines(lines.where(nested), schemas.BOOK_V2)[0])
        if convert:
            parts.append(convert_v1(parse_json_lines(lines.where(~nested), schemas.BOOK_V1)[0], stamp))
    return union_all(parts)


def add_works(master: DataFrame, new: DataFrame, threshold: float = MEDIUM, **how) -> tuple[DataFrame, dict]:
    """(master with the new works, counts). master: WORK_DDL; new: works with _file and _line, their order of arrival.

    Works of the master stay apart. A new work joins its best match among them and the new works before it that found
    none: its editions and formats are merged in and its data sources appended. Only works that change are regrouped.
    """
    first = (master.agg(F.max("_ord")).first()[0] + 1) if master.limit(1).count() else 0
    rows = numbered_within(keep(new, "new"), [], ["_file", "_line"], "_ord").withColumn("_ord", (F.col("_ord") + first).cast("long"))
    like = master.columns
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(master.schema[c].dataType).alias(c) for c in like])
    both = keep(master.withColumn("_settled", F.lit(True)).union(rows.withColumn("_settled", F.lit(False))), "both")
    books = both.select(F.col("_ord").alias("id"), "title", F.try_element_at("authors", F.lit(1)).alias("author"), F.try_element_at(T.edition_isbns("editions"), F.lit(1)).alias("isbn"))
    forms = match_forms(books).join(both.select(F.col("_ord").alias("id"), F.col("_settled").alias("settled")), "id").withColumn("ord", F.col("id"))
    leaders = keep(greedy_merge(forms, threshold, **how), "leaders")
    joined = leaders.where("id <> leader")
    grown = joined.select(F.col("leader").alias("_ord")).distinct()
    alone = both.join(leaders.where("id = leader").select(F.col("id").alias("_ord")), "_ord", "left_semi").join(grown, "_ord", "left_anti").select(*like)
    groups = leaders.join(grown.select(F.col("_ord").alias("leader")), "leader", "left_semi").select(F.col("id").alias("_ord"), F.col("leader").alias("_leader"))
    merged = merge_editions(both.join(groups, "_ord").drop("_settled"), ["_leader"]).select(*like)
    counts = leaders.join(both.select(F.col("_ord").alias("id"), "_settled"), "id").agg(F.count_if("_settled").alias("before"), F.count_if(~F.col("_settled") & (F.col("id") == F.col("leader"))).alias("added"), F.count_if(F.col("id") != F.col("leader")).alias("merged")).first().asDict()
    return alone.union(merged), counts


class Master:
    """A master below a folder; every change is a new version, and the newest ones stay as backups."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 10):
        self.spark, self.state = spark, Snapshots(spark, root, WORK_DDL, keep)

    def load(self) -> DataFrame:
        return self.state.load()

    def add(self, works: DataFrame, **how) -> dict:
        out, counts = add_works(self.load(), works, **how)
        return {**counts, "version": self.state.save(out)}

    def rebuild(self, works: DataFrame, **how) -> dict:
        """From all sources anew."""
        out, counts = add_works(self.spark.createDataFrame([], WORK_DDL), works, **how)
        return {**counts, "version": self.state.save(out)}

    def replace(self, works: DataFrame) -> int:
        return self.state.save(works)
