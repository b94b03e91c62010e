"""Token counts in delta-maintained rollups (operator 7).

A rollup is a folder with one sub-folder per committed batch: signed changes of the totals by (source, lang,
tokenizer version), and the new counts of the batch's documents. A batch is applied against the documents' last counts:
an insert or a revision adds the new count and takes the old one off, a delete takes it off. The totals are the sum of
all batches, so they never need a second pass over old texts. A batch claims its number by creating a file, and is
committed by its marker file, written last: a batch that is delivered again finds its marker and changes nothing, one
that broke off is written anew under its claim, and until then no other batch takes its number. Every COMPACT batches
the last counts and the totals so far are written as a base, and older batches aren't read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm.bpe import cached_encoder

KEYS = ["source", "lang", "tokenizer"]
STATE = "doc_id long, source string, lang string, tokenizer string, n_tokens long, alive boolean"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMPACT = 16  # batches after which a new base is written


def whitespace_count(texts: list[str | None]) -> list[int]:
    return [len((t or "").encode().split()) for t in texts]


def bpe_counter(name: str = "word_bpe_49k.json") -> Callable[[list[str | None]], list[int]]:
    def count(texts: list[str | None]) -> list[int]:
        return [len(x) for x in cached_encoder(name).ids(texts)]

    return count


#: Tokenizer version -> maker of a counter, called once per task.
TOKENIZERS: dict[str, Callable[[], Callable[[list[str | None]], list[int]]]] = {"whitespace-1": lambda: whitespace_count, "word_bpe_49k": bpe_counter}


def count_tokens(docs: DataFrame, tokenizers: list[str]) -> DataFrame:
    """doc_id, source, lang, op, tokenizer, n_tokens of each row (doc_id, source, lang, op, text) and tokenizer version. Null texts count 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {name: TOKENIZERS[name]() for name in tokenizers}
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                piece = batch.slice(k, 2000)
                texts = piece.column(4).to_pylist()
                for name, count in counters.items():
                    yield pa.RecordBatch.from_arrays([*piece.columns[:4], pa.array([name] * len(texts), pa.string()), pa.array(count(texts), pa.int64())], names=["doc_id", "source", "lang", "op", "tokenizer", "n_tokens"])

    return docs.mapInArrow(run, "doc_id long, source string, lang string, op string, tokenizer string, n_tokens long")


class TokenRollup:
    """The rollup kept in a folder."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: list[str] | None = None):
        self.spark, self.path, self.tokenizers = spark, path, tokenizers or list(TOKENIZERS)
        self._conf = spark._jsc.hadoopConfiguration()

    def _file(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return p.getFileSystem(self._conf), p

    def _names(self, kind: str) -> list[str]:
        fs, p = self._file(f"{self.path}/{kind}")
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def batches(self) -> list[str]:
        """Committed batches in commit order."""
        return self._names("commits")

    def _read(self, kind: str, ddl: str) -> DataFrame:
        """The rows of the last base and of the batches after it, each with its number `seq`."""
        base = max([int(b) for b in self._names("bases")], default=0)  # the number of batches in it
        paths = [f"{self.path}/{kind}/{b}" for b in self.batches() if int(b.partition("-")[0]) >= base]
        paths += [f"{self.path}/base-{kind}/{base:08d}"] if base else []
        return self.spark.read.schema(ddl + ", seq int").parquet(*paths) if paths else self.spark.createDataFrame([], ddl + ", seq int")

    def _claim(self, number: int, batch_id: str) -> None:
        """Takes a batch number for one batch id; the file is created by one writer alone."""
        fs, p = self._file(f"{self.path}/claims/{number:08d}")
        fs.mkdirs(p.getParent())
        if not fs.exists(p):
            out = fs.create(p, False)
            out.writeUTF(batch_id)
            out.close()
        given = fs.open(p)
        owner = given.readUTF()
        given.close()
        if owner != batch_id:
            raise RuntimeError(f"batch {owner} has number {number} and isn't committed: deliver it again first")

    def _last(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id", "tokenizer").agg(F.max_by(F.struct("source", "lang", "n_tokens", "alive", "seq"), "seq").alias("c")).select("doc_id", "c.source", "c.lang", "tokenizer", "c.n_tokens", "c.alive", "c.seq")

    def compact(self) -> None:
        """Writes the last counts and the totals of all committed batches as a new base."""
        number = len(self.batches())
        self._last(self._read("docs", STATE)).write.mode("overwrite").parquet(f"{self.path}/base-docs/{number:08d}")
        self.totals().withColumn("seq", F.lit(number - 1)).write.mode("overwrite").parquet(f"{self.path}/base-totals/{number:08d}")
        fs, p = self._file(f"{self.path}/bases/{number:08d}")
        fs.mkdirs(p.getParent())
        fs.create(p, True).close()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Applies a batch once; False if it is committed already.

        changes: doc_id, source, lang, text, op ('insert', 'revise' or 'delete'; null is insert), and perhaps order
        (long); other columns are ignored. Of several changes of a document in one batch the one with the largest order
        counts, null or absent being least; then a delete before a revision before an insert, then the largest (source,
        lang, count). Deletes of unknown documents and null doc_ids change nothing; a revision may change source and
        language. An empty batch is committed and changes nothing.
        """
        done = self.batches()
        if any(b.partition("-")[2] == batch_id for b in done):
            return False
        self._claim(len(done), batch_id)
        name = f"{len(done):08d}-{batch_id}"
        op = F.coalesce(F.col("op").cast("string"), F.lit("insert"))
        order = F.col("order").cast("long") if "order" in changes.columns else F.lit(None).cast("long")
        rank = F.struct(order.alias("order"), F.when(op == "delete", 2).when(op == "revise", 1).otherwise(0).alias("strength"))
        plain = changes.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), rank.alias("rank"), F.when(op != "delete", F.col("text").cast("string")).alias("text"))
        new = count_tokens(plain.where("doc_id is not null").select("doc_id", "source", "lang", F.to_json("rank").alias("op"), "text"), self.tokenizers)
        rank = F.from_json("op", "order long, strength int")
        new = new.groupBy("doc_id", "tokenizer").agg(F.max(F.struct(rank.alias("rank"), "source", "lang", "n_tokens")).alias("c"))
        gone = F.col("c.rank.strength") == 2
        new = new.select("doc_id", "c.source", "c.lang", "tokenizer", F.when(gone, F.lit(0)).otherwise(F.col("c.n_tokens")).cast("long").alias("n_tokens"), (~gone).alias("alive"))
        new.withColumn("seq", F.lit(len(done))).write.mode("overwrite").parquet(f"{self.path}/docs/{name}")
        new = self.spark.read.schema(STATE + ", seq int").parquet(f"{self.path}/docs/{name}")
        gained = new.where("alive").select(*KEYS, F.lit(1).alias("n_docs"), "n_tokens")
        if done:
            ids = new.select("doc_id", "tokenizer")
            last = self._last(self._read("docs", STATE).join(ids, ["doc_id", "tokenizer"], "left_semi"))
            gained = gained.union(last.where("alive").select(*KEYS, F.lit(-1).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
        delta = gained.groupBy(*KEYS).agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens"))
        delta.withColumn("seq", F.lit(len(done))).write.mode("overwrite").parquet(f"{self.path}/totals/{name}")
        fs, p = self._file(f"{self.path}/commits/{name}")
        fs.mkdirs(p.getParent())
        fs.create(p, False).close()
        if (len(done) + 1) % COMPACT == 0:
            self.compact()
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches; cells without documents are left out."""
        out = self._read("totals", TOTALS).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return out.where("n_docs <> 0 or n_tokens <> 0")
