"""State in versions: whole snapshots or lists of segments, of which one small file names the current one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Versions:
    """Numbered manifests below root; the highest is the current state.

    A manifest is written beside its name and renamed, which swaps the state at once: a crash before leaves the old
    state, and what it had written is deleted by the next expire(). One writer at a time; readers are free.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 10):
        self.spark, self.root, self.kept = spark, root.rstrip("/"), keep
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p = self._path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.root}/manifests") if n.endswith(".json"))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/manifests/{number:09d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> dict | None:
        n = self.numbers()
        return self.read(n[-1]) if n else None

    def folder(self) -> str:
        """A new folder for data that a manifest will name."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def publish(self, folders: list[str], **more) -> int:
        """Makes these folders the state. Their files must be complete."""
        number = (self.numbers() or [0])[-1] + 1
        final, draft = f"{self.root}/manifests/{number:09d}.json", f"{self.root}/manifests/{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(json.dumps({"folders": [f.rsplit("/", 1)[-1] for f in folders], **more}).encode()))
        stream.close()
        if self._fs.exists(self._path(final)) or not self._fs.rename(self._path(draft), self._path(final)):
            raise RuntimeError(f"version {number} was published by another writer")
        return number

    def folders(self, manifest: dict) -> list[str]:
        return [f"{self.root}/data/{n}" for n in manifest["folders"]]

    def expire(self) -> list[int]:
        """Deletes the versions beyond the newest `keep`, drafts, and data that no version names; the numbers that went."""
        numbers = self.numbers()
        old = numbers[: -self.kept] if len(numbers) > self.kept else []
        for n in old:
            self._fs.delete(self._path(f"{self.root}/manifests/{n:09d}.json"), False)
        for n in self._names(f"{self.root}/manifests"):
            if n.endswith(".draft"):
                self._fs.delete(self._path(f"{self.root}/manifests/{n}"), False)
        named = {f for n in self.numbers() for f in self.read(n)["folders"]}
        for f in self._names(f"{self.root}/data"):
            if f not in named:
                self._fs.delete(self._path(f"{self.root}/data/{f}"), True)
        return old

    def restore(self, number: int) -> int:
        """Publishes an older version again, as the newest."""
        m = self.read(number)
        return self.publish(self.folders(m), **{k: v for k, v in m.items() if k != "folders"})


class Snapshots:
    """A table as whole snapshots: save, load, restore and reset. The newest `keep` stay as backups."""

    def __init__(self, spark: SparkSession, root: str, schema: str, keep: int = 10):
        self.spark, self.schema, self.versions = spark, schema, Versions(spark, root, keep)

    def load(self) -> DataFrame:
        m = self.versions.current()
        if m is None or not m["folders"]:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self.versions.folders(m))

    def save(self, df: DataFrame) -> int:
        """df may read the state it replaces. Older snapshots go only after the swap."""
        folder = self.versions.folder()
        like = self.spark.createDataFrame([], self.schema)
        df.select(*like.columns).write.parquet(folder)
        number = self.versions.publish([folder])
        self.versions.expire()
        return number

    def reset(self) -> int:
        """An empty state; the ones before stay among the backups."""
        return self.versions.publish([])

    def restore(self, number: int) -> int:
        return self.versions.restore(number)
