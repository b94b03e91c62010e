"""Partitions follow the rows, not the session's number of shuffle partitions."""

from biblioforge.operators import views
from biblioforge.plans import relational
from biblioforge.store import parts_of_rows

SMALL = "/root/testdata/sf0.001"


def test_works_and_their_tables_come_in_as_many_partitions_as_the_lines_ask_for(spark, monkeypatch):
    lines = relational.table(spark, SMALL, "lineitem")
    n = lines.count()
    assert parts_of_rows(lines, n) == spark.sparkContext.defaultParallelism and parts_of_rows(lines, 100) == -(-n // 100)
    monkeypatch.setattr(relational, "parts_of_rows", lambda stored: parts_of_rows(stored, 100))
    t = relational.tables(spark, SMALL)
    assert {df.rdd.getNumPartitions() for df in t.values()} == {-(-n // 100)}
    for df in (relational.books_flat(spark, SMALL), views.latest_rows(t["editions"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(work_id" in plan and f", {spark.conf.get('spark.sql.shuffle.partitions')})" not in plan


def test_flat_row_of_a_latest_edition_without_formats_has_none(spark):
    t = {
        "works": spark.createDataFrame([(1,), (2,), (3,)], "work_id long"),
        "editions": spark.createDataFrame([(1, 1, 1999, False, 5), (1, 2, 2001, True, 5), (2, 1, 2000, True, 5)], "work_id long, edition_number int, publication_year int, is_latest boolean, pages int"),
        "formats": spark.createDataFrame([(1, 1, "a", "pdf"), (2, 1, None, "pdf"), (2, 1, "b", "kindle"), (2, 1, "b", "pdf")], "work_id long, edition_number int, isbn string, format_type string"),
        "authors": spark.createDataFrame([(3, "x")], "work_id long, author string"),
    }
    got = {tuple(r) for r in views.books_flat(t).select("work_id", "edition_number", "isbns", "formats", "authors").collect()}
    assert got == {(1, 2, None, None, None), (2, 1, "b", "kindle,pdf", None), (3, None, None, None, "x")}
