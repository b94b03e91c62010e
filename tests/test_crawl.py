"""Crawler source: pagination, errors, details, ranges of pages, resumed streams."""

import pytest

from biblioforge.sources.crawl import Catalogue, Category, Crawl, StoredSite, page_url, register_crawl, store_site


def Shelf(content, counts=None, extra=None):  # noqa: N802
    """A catalogue of a dictionary {url: items or an exception}; a local class, which executors can unpickle."""

    class Books(Catalogue):
        def has(self, url):
            return url in content

        def listing(self, url):
            if isinstance(content[url], Exception):
                raise content[url]
            return content[url]

        def details(self, url):
            return extra[url]

        def pages(self, category):
            return (counts or {}).get(category.url)

    return Books()


def items(*names):
    return [{"url": f"http://s/{n}", "title": n, "isbn": None, "price": "$5"} for n in names]


CONTENT = {"http://s/a": items("p", "q"), "http://s/a?pn=2": ValueError("odd"), "http://s/a?pn=3": items("r"), "http://s/b?x=1": items("t"), "http://s/b?x=1&pn=3": items("lost")}
CATEGORIES = [Category("http://s/a", "S", "A"), Category("http://s/b?x=1", "S", "B"), Category("http://s/none", "S", "N")]


def rows(df):
    return sorted(((r.category, r.page, r.pos, r.title, r.error) for r in df.collect()), key=repr)


WANT = sorted([("http://s/a", 1, 0, "p", None), ("http://s/a", 1, 1, "q", None), ("http://s/a", 2, None, None, "ValueError"), ("http://s/a", 3, 0, "r", None), ("http://s/b?x=1", 1, 0, "t", None)], key=repr)


def test_page_urls():
    assert [page_url("http://s/a", 1), page_url("http://s/a", 2), page_url("http://s/b?x=1", 3)] == ["http://s/a", "http://s/a?pn=2", "http://s/b?x=1&pn=3"]


@pytest.mark.parametrize("counts", [None, {"http://s/a": 3, "http://s/none": 0}])
def test_batch(spark, counts):
    register_crawl(spark, "shelf", Crawl(Shelf(CONTENT, counts), CATEGORIES, pages_per_task=2))
    df = spark.read.format("shelf").load()
    assert rows(df) == WANT and df.rdd.getNumPartitions() == (4 if counts is None else 3) - (counts is None)
    register_crawl(spark, "shelf", Crawl(Shelf(CONTENT, counts), CATEGORIES, max_pages=1))
    assert rows(spark.read.format("shelf").load()) == [w for w in WANT if w[1] == 1]
    register_crawl(spark, "shelf", Crawl(Shelf(CONTENT), []))
    assert rows(spark.read.format("shelf").load()) == []


def test_details(spark):
    extra = {"http://s/p": {"pages": 12, "price": None}, "http://s/r": {"price": "$6"}, "http://s/t": {}}
    register_crawl(spark, "shelf", Crawl(Shelf(CONTENT, extra=extra), CATEGORIES, with_details=True))
    got = {r.title: (r.fields, r.error) for r in spark.read.format("shelf").load().where("pos is not null").collect()}
    assert got == {"p": ({"price": "$5", "pages": "12"}, None), "q": ({"price": "$5"}, "KeyError"), "r": ({"price": "$6"}, None), "t": ({"price": "$5"}, None)}


def test_stream_resumes_and_sees_new_pages(spark, tmp_path):
    def run(content, **more):
        register_crawl(spark, "shelf", Crawl(Shelf(content), CATEGORIES, **more))
        q = spark.readStream.format("shelf").load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
        q.processAllAvailable()
        q.stop()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    assert run(CONTENT, max_pages=1) == [w for w in WANT if w[1] == 1]
    assert run(CONTENT, pages_per_batch=1) == WANT
    later = CONTENT | {"http://s/b?x=1&pn=2": items("new"), "http://s/none": items("first")}
    more = [("http://s/b?x=1", 2, 0, "new", None), ("http://s/b?x=1", 3, 0, "lost", None), ("http://s/none", 1, 0, "first", None)]
    assert run(later) == sorted(WANT + more, key=repr)


def test_a_stream_of_a_large_site_takes_few_batches_and_reads_ahead(spark, tmp_path, monkeypatch):
    items = spark.range(301).selectExpr("if(id < 300, 'a', 'b') AS category", "id", "concat('u', id) AS url", "concat('t', id) AS title")
    site, batches = StoredSite(store_site(items, "id", per_page=2)), 0
    a, b = Category("http://s/a", "S", "A"), Category("http://s/b", "S", "B")
    assert (site.pages(a), site.pages(b), site.pages(Category("http://s/c", "S", "C"))) == (150, 1, 0)
    for limit in (5, None):
        register_crawl(spark, "large", Crawl(site, [a, b], max_pages=limit, pages_per_batch=1, pages_per_task=40, catch_up=True))
        q = spark.readStream.format("large").load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
        q.processAllAvailable()
        batches = q.lastProgress["batchId"]
        q.stop()
    got = spark.read.parquet(str(tmp_path / "out")).selectExpr("category", "page", "pos", "title").collect()
    assert sorted(map(tuple, got)) == sorted([("http://s/a", k // 2 + 1, k % 2, f"t{k}") for k in range(300)] + [("http://s/b", 1, 0, "t300")])
    assert batches <= 12  # 150 pages one by one before

    import pyarrow.dataset as ds

    opened, plain = [], ds.dataset
    monkeypatch.setattr(ds, "dataset", lambda *x, **more: opened.append(1) or plain(*x, **more))
    assert [i["title"] for k in range(1, 151) for i in site.listing(page_url(a.url, k))] == [f"t{k}" for k in range(300)]
    assert len(opened) <= 4


def test_a_stored_site_with_a_gap_ends_there(spark, tmp_path):
    spark.createDataFrame([("a", k, "[]") for k in (1, 2, 4)], "category string, page int, body string").write.parquet(str(tmp_path / "site"))
    site = StoredSite(str(tmp_path / "site"))
    assert site.pages(Category("http://s/a", "S", "A")) is None and [site.has(page_url("http://s/a", k)) for k in (1, 2, 3, 4)] == [True, True, False, True]
