"""Command line: python -m biblioforge COMMAND ... over JSON Lines masters and query tables."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="biblioforge")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of the registered queries")
    add = sub.add_parser("run", help="one query over a folder of tables")
    add.add_argument("name")
    add.add_argument("tables")
    add.add_argument("--out", help="Parquet folder; else the first rows are shown")
    for name, what in (("convert", "flat records (v1) to nested works (v2)"), ("flatten", "nested works to relational tables"), ("stats", "totals of a master"), ("merge", "works of one master by id, first one first")):
        add = sub.add_parser(name, help=what)
        add.add_argument("source", nargs="+" if name == "merge" else None)
        if name != "stats":
            add.add_argument("--out", required=True)
    for name, what in (("init", "a master from sources"), ("rebuild", "the same, as a new version of a master"), ("add", "sources to a master, with deduplication")):
        add = sub.add_parser(name, help=what)
        add.add_argument("source", nargs="+", help="JSON Lines files or folders, flat or nested records")
        add.add_argument("--master", required=True)
        add.add_argument("--pattern", help="names of the files in folders, such as *_v2.jsonl")
        add.add_argument("--no-convert-v1", action="store_true")
    add = sub.add_parser("enrich", help="fill a master from lookup tables (JSON Lines: isbn, title, ord, entry)")
    add.add_argument("--master", required=True)
    add.add_argument("--catalogue", required=True, help="by ISBN, for Japanese works")
    add.add_argument("--volumes", required=True, help="by ISBN, else by title")
    add.add_argument("--dry-run", action="store_true")
    add = sub.add_parser("review", help="apply decided actions (JSON Lines: work_id, action, new_segment, new_subsegment)")
    add.add_argument("--master", required=True)
    add.add_argument("actions")
    add = sub.add_parser("validate", help="check JSON Lines against the work schema, or another; exit 1 with errors")
    add.add_argument("source")
    add.add_argument("--schema")
    add = sub.add_parser("export", help="a master as JSON Lines")
    add.add_argument("--master", required=True)
    add.add_argument("--out", required=True)
    add = sub.add_parser("restore", help="an older version of a master as the newest")
    add.add_argument("--master", required=True)
    add.add_argument("version", type=int)
    return p


def _maintain(spark: SparkSession, a: argparse.Namespace) -> None:
    from biblioforge.operators.chain import ENTRY, Source, enrich_works
    from biblioforge.operators.master import Master, read_records
    from biblioforge.operators.review import apply_actions
    from biblioforge.sources import io

    stamp, master = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), Master(spark, a.master)
    if a.command in ("init", "rebuild", "add"):
        if a.command == "init" and master.state.versions.current():
            raise SystemExit("there is a master already; use rebuild")
        works = read_records(spark, a.source, stamp, not a.no_convert_v1, a.pattern)
        told = master.add(works) if a.command == "add" else master.rebuild(works)
        print(" ".join(f"{k}={v}" for k, v in told.items()))
    elif a.command == "enrich":
        source = lambda path: io.read_json_lines(spark, path, f"isbn string, title string, ord long, entry {ENTRY}")
        out = enrich_works(master.load(), [Source("catalogue", source(a.catalogue), languages=["ja"]), Source("volumes", source(a.volumes), by_title=True)], stamp)
        out.select(F.explode("changes").alias("change")).groupBy("change").count().orderBy("change").show(200, False)
        if not a.dry_run:
            print(f"version={master.replace(out)}")
    elif a.command == "review":
        actions = io.read_json_lines(spark, a.actions, "work_id string, action string, new_segment string, new_subsegment string")
        print(f"version={master.replace(apply_actions(master.load(), actions))}")
    elif a.command == "export":
        io.write_json_lines(master.load().orderBy("_ord").drop("_ord"), a.out)
    else:
        print(f"version={master.state.restore(a.version)}")


def _validate(spark: SparkSession, source: str, schema: str | None) -> None:
    import json

    from biblioforge import schemas
    from biblioforge.operators.json_schema import validate_json
    from biblioforge.sources.io import numbered_lines

    rules = json.loads("\n".join(r.value for r in spark.read.text(schema).collect())) if schema else schemas.WORK_SCHEMA
    lines = numbered_lines(spark, source)
    found = validate_json(lines, rules)
    for r in found.orderBy("_src", "line", "path").limit(1000).collect():  # what is shown; all are counted
        print(f"Line {r.line}: {r.path}: {r.message}")
    if n := found.count():
        raise SystemExit(f"Validation failed with {n} error(s).")
    print(f"Validation passed: {source} ({lines.where('trim(value) <> \'\'').count()} records)")


def _master(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Nested works of JSON Lines files in the order of the files and their lines."""
    from biblioforge.operators.model import union_all
    from biblioforge.schemas import EDITION

    text = "work_id title subtitle language publisher segment subsegment perspective series instrument_or_asset_class jurisdiction audience_level official_status related_regulation qualification_target notes recommended_for last_reviewed_at dataset_status created_at updated_at".split()
    schema = ", ".join([*[f"{c} string" for c in text], *[f"{c} array<string>" for c in ("authors", "editors", "topics", "data_sources")], f"editions array<{EDITION}>"])
    parts = [spark.read.schema(schema).json(p).withColumn("_ord", F.struct(F.lit(k).alias("file"), F.monotonically_increasing_id().alias("line"))) for k, p in enumerate(paths)]
    return union_all(parts)


def main(arguments: list[str] | None = None) -> None:
    from biblioforge import registry
    from biblioforge.operators import model, views
    from biblioforge.sources import io

    a = parser().parse_args(arguments)
    if a.command == "queries":
        print("\n".join(sorted(registry.queries())))
        return
    spark = SparkSession.builder.appName("biblioforge").getOrCreate()
    if a.command == "run":
        out = registry.queries()[a.name](spark, a.tables)
        out.write.mode("overwrite").parquet(a.out) if a.out else out.show(20, False)
    elif a.command == "convert":
        schema = "record_id string, title string, subtitle string, authors array<string>, publisher string, series string, edition string, publication_year int, isbn_or_issn string, language string, format string, pages int, segment string, subsegment string, topics array<string>, instrument_or_asset_class string, jurisdiction string, perspective string, audience_level string, official_status string, related_regulation string, qualification_target string, access_type string, source_url string, catalog_url string, data_source string, notes string, recommended_for string, dataset_status string, last_reviewed_at string"
        stamp = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        io.write_json_lines(model.convert_v1(io.read_json_lines(spark, a.source, schema).drop("_src"), stamp), a.out)
    elif a.command == "flatten":
        io.write_tables(model.flatten(_master(spark, [a.source])), a.out)
    elif a.command == "merge":
        io.write_json_lines(model.pick(_master(spark, a.source), ["work_id"], "_ord").drop("_ord"), a.out)
    elif a.command == "validate":
        _validate(spark, a.source, a.schema)
    elif hasattr(a, "master"):
        _maintain(spark, a)
    else:
        views.nested_totals(_master(spark, [a.source])).show(truncate=False)


if __name__ == "__main__":
    main()
