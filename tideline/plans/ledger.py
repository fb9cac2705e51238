"""What a run has finished, so that a repeated one goes on from there.

For each table the ledger keeps the fingerprint of its spec and source files, the
stages that are done, and where the extracted rows are staged.  A run whose
fingerprint is the same reads these rows instead of the source, and does not write a
target again that is whole; a changed file or spec starts anew.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tideline.plans.spec import TableSpec
from tideline.session import remove_path
from tideline.sources.many import file_states, path_exists, resolve_files

EXTRACTED, LOADED = "extract", "load"


@dataclass
class Entry:
    """One table's line: how far it came with this fingerprint."""

    fingerprint: str
    staged: str
    done: str = ""  # the last stage that is finished
    rows: int = 0
    target: str = ""


def fingerprint(spark: SparkSession, spec: TableSpec, data_dir: str | None, steps: object = None) -> str | None:
    """A digest of the spec, the cleaning steps and the source files' names, sizes and times; None where files do not tell."""
    files = spec.source_file_path if spec.source_type != "custom_query" else spec.data_source.get("file_path")
    if not files:
        return None
    named = resolve_files(spark, files, data_dir)
    if spec.source_type == "custom_query":
        named += resolve_files(spark, spec.custom_query, data_dir)
    states = [sorted(file_states(spark, path).items()) for path in named]
    known = json.dumps([asdict(spec), states, repr(steps)], default=str, sort_keys=True)
    return hashlib.sha256(known.encode()).hexdigest()


class Ledger:
    """Entries as small files of a folder, one for each table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _open(self, table: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}.json")
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def entry(self, table: str) -> Entry | None:
        """What is known of a table; None if nothing is, or if a crash cut it short."""
        target, system = self._open(table)
        if not system.exists(target):
            return None
        stream = system.open(target)
        try:
            return Entry(**json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        except (ValueError, TypeError):
            return None
        finally:
            stream.close()

    def write(self, table: str, entry: Entry) -> None:
        target, system = self._open(table)
        stream = system.create(target, True)
        try:
            stream.write(bytearray(json.dumps(asdict(entry)).encode()))
        finally:
            stream.close()

    def close(self, table: str) -> None:
        """The table is finished: its staged rows and its entry go."""
        if entry := self.entry(table):
            remove_path(self.spark, entry.staged)
        target, system = self._open(table)
        system.delete(target, False)

    def resumable(self, table: str, mark: str | None) -> Entry | None:
        """The entry to go on from; rows staged for another fingerprint are removed."""
        entry = self.entry(table)
        if entry is None:
            return None
        if mark is None or entry.fingerprint != mark or not path_exists(self.spark, f"{entry.staged}/_SUCCESS"):
            self.close(table)
            return None
        return entry

    def rows(self, entry: Entry) -> DataFrame:
        return self.spark.read.parquet(entry.staged)
