"""Small JSON files about a dataset: schema, validation, transform plan, execution report."""
from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession

from sluicebox.sources.tables import base_name


class Artifacts:
    """A directory of JSON files, one of each sort per dataset; saving replaces.

    With a URI (``scheme://...``) the files are written and read by Hadoop's
    file system, so they can lie where a cluster keeps its files.

    Plans and execution reports end differently, so a report is never taken for a plan.
    """

    SCHEMA, VALIDATION, PLAN, EXECUTION = "schema_after", "validation", "transformation", "execution"
    #: What a dataset's file looked like when it was last cleaned.
    SOURCE = "source"

    def __init__(self, directory: str | Path):
        self.remote = "://" in str(directory)
        self.directory = str(directory).rstrip("/") if self.remote else Path(directory)

    def path(self, dataset: str, sort: str) -> str | Path:
        name = f"{base_name(dataset)}_{sort}.json"
        return f"{self.directory}/{name}" if self.remote else self.directory / name

    @staticmethod
    def _hadoop(path: str):
        spark = SparkSession.active()
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(spark._jsc.hadoopConfiguration())

    def save(self, dataset: str, sort: str, content: dict) -> str | Path:
        path, text = self.path(dataset, sort), json.dumps(content, indent=2, ensure_ascii=False)
        if self.remote:
            where, system = self._hadoop(path)
            out = system.create(where, True)
            try:
                out.write(bytearray(text.encode("utf-8")))
            finally:
                out.close()
        else:
            self.directory.mkdir(parents=True, exist_ok=True)
            path.write_text(text, encoding="utf-8")
        return path

    def load(self, dataset: str, sort: str) -> dict | None:
        path = self.path(dataset, sort)
        if not self.remote:
            return json.loads(path.read_text(encoding="utf-8")) if path.exists() else None
        where, system = self._hadoop(path)
        if not system.exists(where):
            return None
        stream = system.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
