"""Stored tables: immutable batch folders and a manifest that says which of them count.

    <table>/batches/<batch>-<unique>/*.parquet    written once, never changed
    <table>/manifest/<number>.json                the table after each commit; the highest number holds

A batch is first written whole and then committed by publishing the next
manifest, so readers see all of a batch or nothing, and a write that fails half
way leaves the table as it was.  A retried batch takes the place of its earlier
try under the same id.  Two writers that commit at once cannot both publish one
number; the later one reads the table again and publishes the next.  Files are
reached through Spark's own Hadoop file systems, so any URI that Spark reads
will do.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Commits that may be lost to other writers before one gives up.
TRIES = 20


@dataclass
class Manifest:
    """Committed batches (id -> folder, in order of first commit), the schema and what other tables this one includes."""

    number: int
    schema: dict
    batches: dict[str, str]
    #: table -> {batch id: folder} whose rows are already counted in this table
    applied: dict[str, dict[str, str]] = field(default_factory=dict)


class Folder:
    """A folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "", folders: bool = False) -> list[str]:
        """Names of the files, or of the folders, in a folder; none if there is no such folder."""
        at = self._at(name)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory() == folders)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Create the file with all of its text at once; false if there is one already."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        none = self.spark._sc._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self._at(name), none)
            return True
        except Exception:
            self._fs.delete(draft, False)
            if self._fs.exists(self._at(name)):
                return False
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _name(number: int) -> str:
    return f"manifest/{number:012d}.json"


def current(spark: SparkSession, table_path: str) -> Manifest | None:
    """The manifest that holds, or None if the folder is no stored table."""
    folder = Folder(spark, table_path)
    numbers = [int(n[:-5]) for n in folder.names("manifest") if re.fullmatch(r"\d+\.json", n)]
    if not numbers:
        return None
    return Manifest(max(numbers), **json.loads(folder.read(_name(max(numbers)))))


def commit(spark: SparkSession, table_path: str, change) -> Manifest:
    """Publish ``change(manifest or None)``, which is called again if another writer was first."""
    folder = Folder(spark, table_path)
    for _ in range(TRIES):
        now = current(spark, table_path)
        new = change(now)
        new.number = now.number + 1 if now else 1
        text = json.dumps({"schema": new.schema, "batches": new.batches, "applied": new.applied})
        if folder.publish(_name(new.number), text):
            return new
    raise RuntimeError(f"{TRIES} commits to {table_path} were lost to other writers")


def write_batch(df: DataFrame, table_path: str, batch_id: str) -> str:
    """Write the rows of a batch to a folder of their own, not yet committed; its name."""
    if not re.fullmatch(r"[A-Za-z0-9_.=-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits and _.=- only")
    name = f"{batch_id}-{uuid.uuid4().hex}"
    df.write.parquet(f"{table_path.rstrip('/')}/batches/{name}")
    return name


def read(spark: SparkSession, table_path: str, manifest: Manifest, schema: str | StructType | None = None,
         batches: list[str] | None = None) -> DataFrame:
    """Rows of the given batches (all by default) with the declared schema, else the one they were written with."""
    declared = schema or StructType.fromJson(manifest.schema)
    chosen = manifest.batches if batches is None else {b: manifest.batches[b] for b in batches}
    if not chosen:
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).parquet(*(f"{table_path.rstrip('/')}/batches/{f}" for f in chosen.values()))


def remove_unlisted(spark: SparkSession, table_path: str) -> list[str]:
    """Delete batch folders that the manifest does not list (failed or replaced tries); run it while nobody writes."""
    now = current(spark, table_path)
    folder = Folder(spark, table_path)
    listed = set(now.batches.values()) if now else set()
    gone = [f for f in folder.names("batches", folders=True) if f not in listed]
    for f in gone:
        folder.delete(f"batches/{f}")
    return gone
