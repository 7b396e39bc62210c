"""Tables that change by partitions and are seen at one version.

A manifest is a small document in a folder of its own, one file for each version; readers take the newest and nothing is changed in
place, so they see all tables of a version or none of it. A partition that a version does not touch keeps its files. Batches of a
stream are noted by number, so a repeated one is known. There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The partition column of every table; its values are plain words, numbers or dates.
PART = "part"


class Manifest:
    """The documents of a folder by version."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        path = self._paths(folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def versions(self) -> list[int]:
        return [int(x[:-5]) for x in self.listed(self.folder) if x.endswith(".json") and x[:-5].isdigit()]

    def at(self, version: int) -> dict:
        stream = self.fs.open(self._paths(f"{self.folder}/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> dict:
        """The newest document; before the first: version 0, no tables and no batches."""
        held = self.versions()
        return self.at(held[-1]) if held else {"version": 0, "tables": {}, "batches": {}}

    def publish(self, document: dict) -> int:
        """The document as the next version: written aside, then renamed."""
        version = document["version"] + 1
        final, aside = (self._paths(f"{self.folder}/{x}") for x in (f"{version:012d}.json", f".{uuid.uuid4().hex}"))
        out = self.fs.create(aside)
        out.write(json.dumps(document | {"version": version}).encode())
        out.close()
        if self.fs.exists(final) or not self.fs.rename(aside, final):
            self.fs.delete(aside, False)
            raise RuntimeError(f"another writer published version {version} of {self.folder}")
        return version

    def remove(self, folder: str) -> None:
        self.fs.delete(self._paths(folder), True)


class Published:
    """Partitioned tables under ``path`` that are published together. ``schemas`` names them and their columns, without the partition column."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str]):
        self.spark, self.path, self.schemas = spark, path, schemas
        self.manifest = Manifest(spark, f"{path}/_manifest")

    def read(self, table: str, parts: list[str] | None = None, at: dict | None = None) -> DataFrame:
        """A table, or some of its partitions, with the column ``part``, at the newest version or at that of a document."""
        held = (at or self.manifest.newest())["tables"].get(table, {})
        folders = [f"{self.path}/{table}/run={run}/{PART}={p}" for p, run in held.items() if parts is None or p in parts]
        schema = f"{self.schemas[table]}, {PART} string"
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, run string").option("basePath", f"{self.path}/{table}").parquet(*folders)
        return rows.drop("run")

    def has(self, stream: str, batch: int) -> bool:
        """Whether a batch of a stream is published, or a later one."""
        return self.manifest.newest()["batches"].get(stream, -1) >= batch

    def publish(self, frames: dict[str, tuple[DataFrame, list[str] | None]], stream: str = "", batch: int = -1, at: dict | None = None) -> int:
        """Replace partitions of tables: of each the rows, with ``part``, and the partitions that these are all of (none: the whole table).
        Rows may be read from the table itself. ``at``: the document that the rows were read from."""
        document = at or self.manifest.newest()
        run, tables = uuid.uuid4().hex, {k: dict(v) for k, v in document["tables"].items()}  # no other try writes to this run's folders
        for name, (rows, parts) in frames.items():
            folder = f"{self.path}/{name}/run={run}"
            columns = [f.name for f in self.spark.createDataFrame([], self.schemas[name]).schema]
            rows.select(*columns, PART).repartition(PART).write.partitionBy(PART).parquet(folder)
            now = [x.split("=", 1)[1] for x in self.manifest.listed(folder) if x.startswith(f"{PART}=")]
            held = {} if parts is None else {p: v for p, v in tables.get(name, {}).items() if p not in parts}
            tables[name] = held | dict.fromkeys(now, run)
        batches = document["batches"] | ({stream: batch} if stream else {})
        return self.manifest.publish({"version": document["version"], "tables": tables, "batches": batches})

    def clean(self, keep: int = 10) -> None:
        """Remove folders that none of the last ``keep`` versions names, and older manifests. Readers of those versions go on; a writer must not be at work."""
        held = self.manifest.versions()
        last = [self.manifest.at(v) for v in held[-keep:]]
        for table in self.schemas:
            used = {f"run={run}" for d in last for run in d["tables"].get(table, {}).values()}
            for x in self.manifest.listed(f"{self.path}/{table}"):
                if x.startswith("run=") and x not in used:
                    self.manifest.remove(f"{self.path}/{table}/{x}")
        for v in held[:-keep]:
            self.manifest.remove(f"{self.manifest.folder}/{v:012d}.json")


def bucket_of(*keys: str, n: int = 64):
    """The partition of a row by hash, as a word."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("string")
