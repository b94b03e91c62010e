"""Loads that enforce constraints: good rows to the table, bad ones to its quarantine, counted in the same pass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class Constraints:
    """What a table's rows must hold.

    required: columns that may not be null. checks: {name: condition}; a condition that is null is met, as in SQL.
    foreign: {name: (columns, parent table, its columns)}; rows with a null among the columns refer to nothing.
    unique: key columns, of which the first row by `order` (unique in a key) stays; nulls are no keys.
    """

    required: list[str] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)
    foreign: dict[str, tuple[list[str], str, list[str]]] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    order: str | None = None

    def names(self) -> list[str]:
        return [f"required:{c}" for c in self.required] + [f"check:{c}" for c in self.checks] + [f"foreign:{c}" for c in self.foreign] + [f"unique:{c}" for c in self.unique]


def _null_free(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def broken_rules(rows: DataFrame, rules: Constraints, loaded: dict[str, DataFrame]) -> DataFrame:
    """rows plus _broken: names of the rules that a row breaks. Uniqueness is judged among rows that break nothing else."""
    for name, (columns, parent, keys) in rules.foreign.items():
        known = loaded[parent].select(*[F.col(k).alias(f"_{name}_{i}") for i, k in enumerate(keys)]).where(_null_free([f"_{name}_{i}" for i in range(len(keys))])).distinct().withColumn(f"_has_{name}", F.lit(True))
        same = F.lit(True)
        for i, c in enumerate(columns):
            same = same & (F.col(c) == F.col(f"_{name}_{i}"))
        rows = rows.join(known, same, "left").drop(*[f"_{name}_{i}" for i in range(len(keys))])
    found = [F.when(F.col(c).isNull(), F.lit(f"required:{c}")) for c in rules.required]
    found += [F.when(~F.coalesce(bad, F.lit(True)), F.lit(f"check:{name}")) for name, bad in rules.checks.items()]
    found += [F.when(F.col(f"_has_{name}").isNull() & _null_free(columns), F.lit(f"foreign:{name}")) for name, (columns, _, _) in rules.foreign.items()]
    out = rows.withColumn("_broken", F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")).drop(*[f"_has_{n}" for n in rules.foreign])
    firsts = out.where("size(_broken) = 0")
    for name, columns in rules.unique.items():
        first = firsts.where(_null_free(columns)).groupBy(*[F.col(c).alias(f"_{name}_{c}") for c in columns]).agg(F.min(rules.order).alias(f"_first_{name}"))
        same = F.lit(True)
        for c in columns:
            same = same & (F.col(c) == F.col(f"_{name}_{c}"))
        again = (F.size("_broken") == 0) & (F.col(rules.order) != F.col(f"_first_{name}"))
        out = out.join(first, same, "left").withColumn("_again", again)
        out = out.withColumn("_broken", F.when(F.coalesce("_again", F.lit(False)), F.array(F.lit(f"unique:{name}"))).otherwise(F.col("_broken"))).drop("_again", f"_first_{name}", *[f"_{name}_{c}" for c in columns])
    return out


def guarded_load(spark: SparkSession, tables: dict[str, tuple[DataFrame, Constraints]], path: str) -> list[tuple[str, str, int]]:
    """Loads tables in the order given (parents first) and gives (table, outcome, rows): 'loaded', 'rejected' and each rule.

    Each table is one job that writes both sinks, `path/table/ok=true` and `path/table/ok=false`, and counts with
    observe(). Foreign keys are met by rows of the parent that were loaded, not by those in its quarantine.
    """
    loaded, counts = {}, []
    for name, (rows, rules) in tables.items():
        told = Observation(name)
        judged = broken_rules(rows, rules, loaded).withColumn("ok", F.size("_broken") == 0)
        measures = [F.count_if("ok").alias("loaded"), F.count_if(~F.col("ok")).alias("rejected"), *[F.count_if(F.array_contains("_broken", r)).alias(r) for r in rules.names()]]
        judged.observe(told, *measures).write.partitionBy("ok").parquet(f"{path}/{name}")
        counts += [(name, outcome, int(n)) for outcome, n in told.get.items()]
        loaded[name] = read_loaded(spark, path, name, rows)
    return counts


def _sink(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    return spark.read.schema(f"{schema}, _broken array<string>, ok boolean").parquet(f"{path}/{name}")


def read_loaded(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    """The rows of a table that were loaded, with the columns of `like`."""
    return _sink(spark, path, name, like).where("ok").drop("_broken", "ok")


def read_quarantine(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    """The rows that weren't, and _broken: the rules they break."""
    return _sink(spark, path, name, like).where("NOT ok").drop("ok")
