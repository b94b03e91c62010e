"""The matching index as kept tables: bucketed by key, in segments that batches add, found without shuffling the index."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators.matching import MEDIUM, _keys, _words, enough_grams, near_enough, ngram_candidates, score_pairs, sided
from biblioforge.sources.versions import Versions
from biblioforge.store import keep

TABLES = {"keys": ("key string, tier int, id bigint", "key"), "words": ("word string, id bigint", "word"), "books": ("id bigint, title string, author string, norm string, agg string, who string, code string", "id")}
#: So many probe keys are named in the filter, so that the scan opens their buckets alone.
NAMED = 500


class KeptIndex:
    """keys (ISBN, its prefix, normal and aggressive title, each -> id), words (of the normal title, and the aggressive one as a whole, -> id) and books (by id), each in buckets.

    A batch is one more segment; compact() makes one of all. Every join with a segment uses its buckets: probes are
    shuffled to them, the index never is. Segments are joined one by one, so many of them cost passes: compact then.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.buckets, self.versions = spark, buckets, Versions(spark, path)

    def _write(self, df: DataFrame, name: str, folder: str) -> None:
        table, key = f"kept_{uuid.uuid4().hex}", TABLES[name][1]
        df.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(key).option("path", f"{folder}/{name}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # external: the files stay

    def _open(self, name: str, folder: str) -> DataFrame:
        ddl, key = TABLES[name]
        table = f"kept_{folder.rsplit('/', 1)[-1]}_{name}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{folder}/{name}'")
        return self.spark.table(table)

    def segments(self, name: str) -> list[DataFrame]:
        m = self.versions.current()
        return [self._open(name, f) for f in self.versions.folders(m)] if m else []

    def _rows(self, forms: DataFrame) -> dict[str, DataFrame]:
        full = forms.select("id", "title", "author", *[F.coalesce(c, F.lit("")).alias(c) for c in ("norm", "agg", "who", "code")])
        keys = _keys(full, "id").select(F.concat_ws(":", "tier", "key").alias("key"), F.col("tier").cast("int").alias("tier"), "id")
        return {"keys": keys, "words": sided(full, "r").where("r_agg <> ''").select(F.explode(_words("r")).alias("word"), F.col("r_id").alias("id")), "books": full}

    def _add(self, tables: dict[str, DataFrame], others: list[str]) -> int:
        folder = self.versions.folder()
        for name, df in tables.items():
            self._write(df.select(*[c.split()[0] for c in TABLES[name][0].split(", ")]), name, folder)
        return self.versions.publish([*others, folder], buckets=self.buckets)

    def add(self, forms: DataFrame) -> int:
        """Books (match forms, with ids that the index doesn't hold) as a segment of their own; the others aren't read."""
        m = self.versions.current()
        return self._add(self._rows(keep(forms, "forms")), self.versions.folders(m) if m else [])

    def compact(self) -> int:
        """All segments as one."""
        whole = {}
        for name in TABLES:
            parts = self.segments(name)
            whole[name] = parts[0]
            for p in parts[1:]:
                whole[name] = whole[name].union(p)
        return self._add(whole, [])

    def probe(self, name: str, probes: DataFrame) -> DataFrame:
        """probes (with the table's key column) joined with every segment. Few keys open their buckets alone."""
        key = TABLES[name][1]
        few = [r[0] for r in probes.select(key).distinct().limit(NAMED + 1).collect()]
        out = None
        for segment in self.segments(name):
            segment = segment.where(F.col(key).isin(few)) if len(few) <= NAMED else segment
            found = probes.join(segment, key)
            out = found if out is None else out.union(found)
        return out

    def find(self, new: DataFrame, threshold: float = MEDIUM, overlap: float = 0.3, similarity=T.sequence_ratio, author_ratio=None) -> DataFrame:
        """The best match of each new book (match forms) in the index: l_id, r_id, tier, match_type, confidence, as find_matches() gives it."""
        new = keep(new, "new")
        kinds = F.create_map(*[F.lit(x) for p in enumerate(("isbn_exact", "isbn_prefix", "title_normalized", "title_aggressive"), 1) for x in p])
        sure = F.create_map(*[F.lit(x) for p in ((1, 1.0), (2, 0.98), (3, 0.95), (4, 0.90)) for x in p])
        probes = keep(_keys(new, F.col("id").alias("l_id")).select("l_id", F.concat_ws(":", "tier", "key").alias("key")), "probes")
        hits = self.probe("keys", probes).groupBy("l_id", "tier").agg(F.min("id").alias("r_id"))
        w = Window.partitionBy("l_id").orderBy("tier")
        hits = hits.select("l_id", "r_id", "tier", kinds[F.col("tier")].alias("match_type"), sure[F.col("tier")].alias("confidence")).where(F.col("confidence") >= threshold)
        exact = keep(hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n"), "exact")
        rest = new.join(exact.select(F.col("l_id").alias("id")), "id", "left_anti").where("agg <> ''")
        l = sided(rest, "l")
        if near_enough(threshold - 0.1):
            words = keep(l.select("l_id", F.explode(_words("l")).alias("word")), "words")
            near = self.probe("words", words).select("l_id", "id").distinct()
        else:  # titles without a common word are in reach: all books are counted
            books = [b.select(F.col("id").alias("r"), F.col("agg").alias("text")) for b in self.segments("books")]
            near = ngram_candidates(rest.select(F.col("id").alias("q"), F.col("agg").alias("text")), reduce(DataFrame.union, books), overlap).select(F.col("q").alias("l_id"), F.col("r").alias("id"))
        near = keep(near, "near")
        books = self.probe("books", near).withColumnRenamed("id", "r_id")
        books = books.select("l_id", "r_id", *[F.col(c).alias(f"r_{c}") for c in ("norm", "agg", "who")], F.nullif("code", F.lit("")).alias("r_code"))
        pairs = books.join(l, "l_id").where(enough_grams(overlap))
        fuzzy = score_pairs(pairs, similarity, author_ratio).where(F.col("confidence") >= threshold).select("l_id", "r_id", F.lit(5).alias("tier"), "match_type", "confidence")
        w = Window.partitionBy("l_id").orderBy(F.desc("confidence"), "r_id")
        return exact.union(fuzzy.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n"))
