"""Token-ID output in ORC (operator 3).

Documents are range-partitioned by doc_id, sorted, encoded in that order and written as ORC: one file per range, ids
as integer lists (ORC's run-length encoding), row indexes and a Bloom filter on doc_id, so that readers prune stripes
and row groups by id and read stripes in parallel. A row holds its part number and its offset inside the part; the
parts' totals (one row per file) give the global start. Nothing passes through one task but those totals.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioforge.llm.bpe import WHOLE, WordCache, groups, id_lists, tokenizer_path

END_ID = 1
WRITTEN = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
_KINDS = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


_learners: dict = {}  # by tokenizer, in each Python worker: how to learn pieces, and the cache of those known


def _learner(coder):
    """Gives the ids of pieces. Words go to the library as one text: each ends with a token that ends a word. They are folded and split already, so the library's model gets them at white space."""
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(coder.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    ends = np.zeros(coder.get_vocab_size(), bool)
    ends[[i for t, i in coder.get_vocab().items() if t.endswith("</w>")]] = True

    def some(pieces: list[bytes]) -> list[bytes]:
        words = [p for p in pieces if not p.startswith(WHOLE)]
        ids = np.array(plain.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(ends[ids]) + 1 if len(ids) else np.empty(0, np.int64)
        known = {}
        if len(cuts) == len(words):
            raw = ids.tobytes()
            known = {w: raw[4 * lo : 4 * hi] for w, lo, hi in zip(words, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)}
        rest = [p for p in pieces if p not in known]
        for p, e in zip(rest, coder.encode_batch_fast([p.removeprefix(WHOLE).decode() for p in rest], add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, np.int32).tobytes()
        return [known[p] for p in pieces]

    def learn(pieces: list[bytes]) -> list[bytes]:
        return [x for k in range(0, len(pieces), 2000) for x in some(pieces[k : k + 2000])]

    return learn


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        if name not in _learners:
            coder = Tokenizer.from_file(tokenizer_path(name))
            coder.no_padding()
            coder.no_truncation()
            _learners[name] = _learner(coder), WordCache()
        learn, cache = _learners[name]
        part, start = TaskContext.get().partitionId(), 0
        end = np.int32(END_ID)
        for doc_ids, texts in groups(batches):
            # The tokenizer never merges across pieces, so each is encoded alone, and once.
            ids = [np.append(x, end) for x in cache.ids(texts, learn)]
            size = np.array([len(x) for x in ids], np.int64)
            ends = np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(np.full(len(size), part, np.int32)), pa.array(start + ends - size), pa.array(size), id_lists(ids)], schema=_KINDS
            )
            start += int(ends[-1])

    return run


def write_token_orc(docs: DataFrame, path: str, name: str = "word_bpe_49k.json") -> None:
    """Writes doc_id, part, start_in_part, n_tokens, ids of every row in ascending doc_id (nulls first, ties by text).

    Null or empty texts hold the end id alone. Other columns are ignored. An empty table writes no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    in_order = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = in_order.mapInArrow(_encode(name), WRITTEN)
    options = {"orc.compress": "ZSTD", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
    rows.write.options(**options).orc(path)


def _offsets(rows: DataFrame) -> DataFrame:
    """part, offset: the ids before each part; a row per file."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))


def _started(rows: DataFrame, written: DataFrame, column: str) -> DataFrame:
    return rows.join(_offsets(written), "part").select("doc_id", (F.col("offset") + F.col("start_in_part")).alias("start"), "n_tokens", column)


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written folder with their global `start`: doc_id, start, n_tokens, ids."""
    rows = spark.read.schema(WRITTEN).orc(path)
    return _started(rows, rows, "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(4)
        values = np.asarray(lists.values).astype("<u4", copy=False)
        at = np.asarray(lists.offsets)
        crc = [zlib.crc32(values[lo:hi].tobytes()) for lo, hi in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])


def token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from the files. Ids are summed where they are read; only sums are joined."""
    written = spark.read.schema(WRITTEN).orc(path)
    rows = written.mapInArrow(_checksums, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long")
    return _started(rows, written, "ids_crc32")
