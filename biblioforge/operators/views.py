"""Views and reports over the relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.operators.model import pick


def latest_rows(editions: DataFrame) -> DataFrame:
    """One latest edition per work: the highest number among those marked."""
    return pick(editions.where("is_latest"), ["work_id"], "edition_number", last=True)


def joined(df: DataFrame, key: str, c: str, name: str) -> DataFrame:
    """key, distinct values of c joined by commas in order."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(c)), ",").alias(name))


def books_flat(t: dict[str, DataFrame]) -> DataFrame:
    """A row per work with its latest edition; children are aggregated before the joins, so nothing multiplies."""
    latest = latest_rows(t["editions"]).select("work_id", "edition_number", "publication_year", "pages")
    # Formats meet the latest edition by the work alone, which the tables may be partitioned by, and those of other editions are left out.
    own = F.col("edition_number") == F.col("_top")
    names = lambda c: F.when(F.count_if(own) > 0, F.array_join(F.array_sort(F.collect_set(F.when(own, F.col(c)))), ",")).alias(c + "s")
    f = t["formats"].withColumnRenamed("format_type", "format").join(latest.select("work_id", F.col("edition_number").alias("_top")), "work_id")
    f = f.groupBy("work_id").agg(names("isbn"), names("format"))
    children = latest.join(f, "work_id", "left").join(joined(t["authors"], "work_id", "author", "authors"), "work_id", "full")
    return t["works"].join(children, "work_id", "left")


def coverage(works: DataFrame) -> DataFrame:
    return works.groupBy("segment", "subsegment", "perspective", "language").agg(F.count_distinct("work_id").alias("book_count"), F.count_distinct(F.when(F.col("dataset_status") == "validated", F.col("work_id"))).alias("validated_count"))


def coverage_long(books: DataFrame) -> DataFrame:
    return books.where("dataset_status <> 'rejected'").groupBy("segment", "perspective").agg(F.count("*").alias("cnt"))


def coverage_pivot(long: DataFrame, values: list[str]) -> DataFrame:
    return long.groupBy("segment").pivot("perspective", values).agg(F.sum("cnt")).na.fill(0)


def gaps(long: DataFrame, below: int = 50) -> DataFrame:
    """Cells with fewer books than the threshold; cells without any book aren't seen here."""
    return long.where(F.col("cnt") < below).orderBy("cnt")


def gaps_dense(long: DataFrame, segments: DataFrame, values: list[str], below: int = 50) -> DataFrame:
    """As gaps, with the cells that no book has: every segment of the taxonomy by every perspective."""
    cells = segments.select("segment").distinct().select("segment", F.explode(F.array(*[F.lit(v) for v in values])).alias("perspective"))
    full = cells.join(long, ["segment", "perspective"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    return full.where(F.col("cnt") < below)


def recent(t: dict[str, DataFrame], since: int = 2020) -> DataFrame:
    e = latest_rows(t["editions"]).select("work_id", "publication_year")
    return t["works"].join(e.where(F.col("publication_year") >= since), "work_id").orderBy(F.desc("publication_year"))


def by_isbn(t: dict[str, DataFrame], isbn: str) -> DataFrame:
    f = t["formats"].where(F.col("isbn") == isbn).select("work_id", "edition_number", "isbn")
    few = t["editions"].join(f.select("work_id").distinct(), "work_id", "left_semi")  # by the work first: editions may be partitioned by it
    return t["works"].join(few.join(f, ["work_id", "edition_number"]), "work_id")


def group_count(df: DataFrame, c: str, default: str = "unknown") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(c)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c)


def exploded_count(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.explode(c).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def nested_totals(works: DataFrame) -> DataFrame:
    sizes = F.aggregate(F.transform("editions", lambda e: F.size(e["formats"])), F.lit(0), lambda a, x: a + x)
    return works.agg(F.count("*").alias("works"), F.sum(F.size("editions")).alias("editions"), F.sum(sizes).alias("formats"), F.round(F.avg(F.size("editions")), 2).alias("editions_per_work"))


def any_format(test) -> Column:
    """Whether a format of any edition passes a test."""
    return F.coalesce(F.exists("editions", lambda e: F.exists(e["formats"], lambda f: F.coalesce(test(f), F.lit(False)))), F.lit(False))


def any_edition(test) -> Column:
    return F.coalesce(F.exists("editions", lambda e: F.coalesce(test(e), F.lit(False))), F.lit(False))


def presence() -> dict[str, Column]:
    """Name -> whether a nested work has it. A zero price counts as none."""
    full = lambda c: c.isNotNull() & (c != "")
    return {
        "isbn": any_format(lambda f: full(f["isbn"])),
        "price": any_format(lambda f: f["price"]["amount"] != 0),
        "url": any_format(lambda f: full(f["url"])),
        "store_url": any_format(lambda f: F.contains(F.lower(f["url"]), F.lit("amazon"))),
        "valid_url": any_format(lambda f: f["url_status"] == "valid"),
        "description": any_edition(lambda e: full(e["description"])),
        "pages": any_edition(lambda e: e["pages"] > 0),
        "publisher": F.coalesce(~F.col("publisher").isin("", "Unknown"), F.lit(False)),
        "verified": F.coalesce(F.col("dataset_status") == "verified", F.lit(False)),
    }


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, "N/A").otherwise(F.format_string("%.1f%%", 100.0 * part / whole))


def completeness(rows: DataFrame, flags: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Counts with and without each flag and the shares, in one pass; rollup over `by` adds the grand total."""
    cells = [F.count("*").alias("total")]
    for name, flag in flags.items():
        cells += [F.count_if(flag).alias(f"with_{name}"), (F.count("*") - F.count_if(flag)).alias(f"missing_{name}"), percent(F.count_if(flag), F.count("*")).alias(f"share_{name}")]
    return (rows.rollup(*by) if by else rows.groupBy()).agg(*cells)


def incomplete(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows that miss a flag, with the names of those missing."""
    missing = F.array_compact(F.array(*[F.when(~f, F.lit(n)) for n, f in flags.items()]))
    return rows.withColumn("missing", missing).where(F.size("missing") > 0)


def transitions(rows: DataFrame, before: str, after: str) -> DataFrame:
    return rows.groupBy(F.concat_ws(" -> ", before, after).alias("transition")).agg(F.count("*").alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def quality_metrics(works: DataFrame) -> DataFrame:
    return works.groupBy("segment").agg(F.avg((F.col("dataset_status") == "validated").cast("int")).alias("validated_ratio"), F.max("publication_year").alias("newest_year"), F.count_distinct("publication_year").alias("years"))


def register(spark: SparkSession, t: dict[str, DataFrame]) -> None:
    """Temp views for ad-hoc SQL: every table, v_books_flat, v_coverage and v_recent."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    books_flat(t).createOrReplaceTempView("v_books_flat")
    coverage(t["works"]).createOrReplaceTempView("v_coverage")
    recent(t).createOrReplaceTempView("v_recent")
