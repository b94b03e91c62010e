"""Shared helpers of the training-data operators: durable tables, sizes and hashed word streams."""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir. Where it is unset, a local session gets /tmp/checkpoints; a cluster, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "/tmp/checkpoints/biblioforge"
    return base.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables of one operator run below the shared folder; a lost executor never takes them along."""

    roots: list[str] = []  # of all runs in this process that haven't been deleted

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        Scratch.roots.append(self.root)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it back: cuts the lineage without local checkpoints."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Deletes the files of tables that keep() returned and that nothing reads any more."""
        name = self.root.split("/")[-1]
        for f in {os.path.dirname(x) for df in frames for x in df.inputFiles()}:
            if name in f:
                _delete(self.spark, f)


def release(spark: SparkSession, since: int) -> None:
    """Deletes all tables of the runs that began after the first `since` of Scratch.roots. Their results must have been written."""
    for root in Scratch.roots[since:]:
        _delete(spark, root)
    del Scratch.roots[since:]


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, at most 1 PiB."""
    return min(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()), 1 << 50)


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_MIX1, _MIX2, _MIX3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = int(_MIX3)
_BYTE = (np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as far as the longest text needs."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a UTF-8 text; a word is a run of bytes other than \\x20 and \\x09-\\x0D."""
    edge = np.diff(np.concatenate(([True], WHITE[raw], [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, from prefix sums of a polynomial hash: no loop over words."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(text: str | None, lower: bool = False) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data.lower() if lower else data, np.uint8)  # bytes.lower() changes A-Z alone
    return word_hashes(raw, *word_spans(raw))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` words; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _MIX3 + words[i : len(words) - k + 1 + i]
    return mix(out)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    return np.unique(window_hashes(hashed_words(text, lower=True), size))
