"""Validation by declared rules: one row per violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioforge import schemas


def required(c: str) -> tuple[Column, str]:
    return F.col(c).isNull(), f"'{c}' is a required property"


def one_of(c: str, values: list[str]) -> tuple[Column, str]:
    return F.col(c).isNotNull() & ~F.col(c).isin(values), f"'{c}' is not one of the allowed values"


def matches(c: str, pattern: str) -> tuple[Column, str]:
    return F.col(c).isNotNull() & ~F.col(c).rlike(pattern), f"'{c}' does not match {pattern}"


def between(c: str, low: float | None = None, high: float | None = None) -> tuple[Column, str]:
    bad = F.lit(False)
    bad = bad | (F.col(c) < low) if low is not None else bad
    return F.coalesce(bad | (F.col(c) > high) if high is not None else bad, F.lit(False)), f"'{c}' is out of range"


def at_least(c: str, n: int = 1) -> tuple[Column, str]:
    return F.col(c).isNotNull() & (F.size(c) < n), f"'{c}' has too few items"


def work_rules() -> list[tuple[Column, str]]:
    """Rules of a v2 work on the top level and in its editions and formats."""
    some = lambda test: F.coalesce(F.exists("editions", test), F.lit(False))
    return [
        *[required(c) for c in ("work_id", "title", "language", "publisher", "segment", "subsegment", "perspective", "editions", "dataset_status")],
        matches("work_id", "^[a-z0-9_]+$"),
        one_of("language", schemas.LANGUAGES),
        one_of("perspective", schemas.PERSPECTIVES),
        one_of("dataset_status", schemas.STATUSES),
        at_least("editions"),
        between("importance_score", 0, 100),
        (some(lambda e: e["edition_number"].isNull() | (e["edition_number"] < 1)), "an edition number is missing or below 1"),
        (some(lambda e: (e["publication_year"] < 1800) | (e["publication_year"] > 2100)), "a publication year is out of range"),
        (some(lambda e: F.coalesce(F.size(e["formats"]), F.lit(0)) < 1), "an edition has no format"),
        (some(lambda e: F.exists(e["formats"], lambda f: ~f["format_type"].isin(schemas.FORMAT_TYPES))), "a format type is not one of the allowed values"),
        (some(lambda e: F.exists(e["formats"], lambda f: f["price"]["amount"] < 0)), "a price is below 0"),
    ]


def violations(rows: DataFrame, rules: list[tuple[Column, str]], keep: list[str]) -> DataFrame:
    """keep columns and message, one row for each broken rule of each row; a rule that is null isn't broken (SQL CHECK)."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for bad, text in rules]))
    return rows.select(*keep, F.explode(found).alias("message"))


def unknown_keys(lines: DataFrame, allowed: list[str], value: str = "value") -> DataFrame:
    """Rows of raw JSON with the keys that a closed schema doesn't know."""
    keys = F.array_except(F.json_object_keys(value), F.array(*[F.lit(a) for a in allowed]))
    return lines.withColumn("unknown", keys).where(F.size("unknown") > 0)


def duplicates(rows: DataFrame, keys: list[str], nulls_distinct: list[str] | None = None) -> DataFrame:
    """keys and n of keys that occur more than once; rows with a null in nulls_distinct don't count."""
    for c in nulls_distinct or []:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def load_stats(rows: DataFrame, rules: list[tuple[Column, str]], is_new: Column) -> DataFrame:
    """total_records, v2_records, v1_skipped, errors: a record with a broken rule is an error as a whole."""
    bad = F.lit(False)
    for b, _ in rules:
        bad = bad | F.coalesce(b, F.lit(False))
    return rows.agg(F.count("*").alias("total_records"), F.count_if(is_new & ~bad).alias("v2_records"), F.count_if(~is_new).alias("v1_skipped"), F.count_if(is_new & bad).alias("errors"))


def report(found: DataFrame) -> DataFrame:
    """`Line n: message` rows of violations with a line column."""
    return found.select(F.concat(F.lit("Line "), F.col("line"), F.lit(": "), F.col("message")).alias("text"))
