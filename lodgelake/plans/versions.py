"""Tables of one warehouse folder that change together.

Every write goes to a new version folder, ``<table>/v=<number>-<id>``, which
nothing refers to yet.  ``commit`` writes the folders that make up every table
into ``_commits/<number>.json`` and puts that file in place by one rename; it is
the last write of a run.  Readers follow the newest commit file, so they see
either all of a run's tables or none, and a run that stops half-way leaves the
tables as they were.  Folders that no kept commit names are removed by
``vacuum`` only.

A table may be partitioned; then a run can replace some partitions and keep the
folders of the others, or add to them, without writing these again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodgelake.sources import files

COMMITS = "_commits"


class VersionedTables:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        numbers = sorted(n for n in files.list_files(spark, f"{self.base}/{COMMITS}") if n.endswith(".json"))
        self.committed: dict | None = json.loads(self._text(f"{COMMITS}/{numbers[-1]}")) if numbers else None
        self.number = int(numbers[-1].split(".")[0]) + 1 if numbers else 1
        #: Tables as this run will commit them: folders, schema, partition column.
        self.tables: dict[str, dict] = dict(self.committed["tables"]) if self.committed else {}

    # -- reading
    def notes(self) -> dict:
        """What the last commit recorded beside its tables."""
        return self.committed["notes"] if self.committed else {}

    def read(self, name: str) -> DataFrame:
        """A table as this run has it: what it wrote, else what was committed."""
        entry = self.tables[name]
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["folders"]:
            return self.spark.createDataFrame([], schema)
        table = self.spark.read.schema(schema).option("basePath", f"{self.base}/{name}")
        return table.parquet(*(f"{self.base}/{f}" for f in entry["folders"])).select(*schema.names)

    # -- writing
    def put(self, name: str, df: DataFrame, by: str | None = None,
            keep: Callable[[str], bool] | None = None) -> DataFrame:
        """Write a table, or (``keep``) those of its partitions ``by`` that
        ``df`` holds: folders of partition values that ``keep`` accepts stay."""
        folder = f"{name}/v={self.number:06d}-{uuid.uuid4().hex[:8]}"
        writer = df.write
        if by:  # the hint lets AQE size the files
            writer = df.hint("rebalance", by).write.partitionBy(by)
        writer.parquet(f"{self.base}/{folder}")
        folders = [folder]
        if keep is not None and name in self.tables:
            held = [p for f in self.tables[name]["folders"] for p in self._partitions(f, by)]
            folders = [p for p in held if keep(p.rpartition(f"/{by}=")[2])] + self._partitions(folder, by)
        # partition columns come last, as a reader has them
        columns = [f for f in df.schema if f.name != by] + [f for f in df.schema if f.name == by]
        self.tables[name] = {"folders": folders, "schema": T.StructType(columns).jsonValue(), "by": by}
        return self.read(name)

    def commit(self, **notes) -> None:
        """Make this run's tables the current ones."""
        text = json.dumps({"tables": self.tables, "notes": notes})
        fs, folder = files._fs(self.spark, f"{self.base}/{COMMITS}")
        fs.mkdirs(folder)
        jvm = self.spark.sparkContext._jvm
        beside = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(folder, f"{self.number:010d}.json")
        if fs.exists(target) or not fs.rename(beside, target):
            raise RuntimeError(f"another run has committed version {self.number}")
        self.committed, self.number = json.loads(text), self.number + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove version folders that the last ``keep`` commits do not name."""
        numbers = sorted(n for n in files.list_files(self.spark, f"{self.base}/{COMMITS}") if n.endswith(".json"))
        named = {f for n in numbers[-keep:] for t in json.loads(self._text(f"{COMMITS}/{n}"))["tables"].values() for f in t["folders"]}
        roots = {"/".join(f.split("/")[:2]) for f in named}
        removed = []
        for name in self.tables:
            for folder in self._children(name):
                if folder not in roots and "/v=" in folder:
                    fs, p = files._fs(self.spark, f"{self.base}/{folder}")
                    fs.delete(p, True)
                    removed.append(folder)
        return removed

    # -- folders
    def _text(self, path: str) -> str:
        return "\n".join(r[0] for r in self.spark.read.option("wholetext", True).text(f"{self.base}/{path}").collect())

    def _children(self, folder: str) -> list[str]:
        fs, p = files._fs(self.spark, f"{self.base}/{folder}")
        return sorted(f"{folder}/{st.getPath().getName()}" for st in fs.listStatus(p) if st.isDirectory()) if fs.exists(p) else []

    def _partitions(self, folder: str, by: str) -> list[str]:
        """The partition folders of a version folder (or the one that it is)."""
        if f"/{by}=" in folder:
            return [folder]
        return [c for c in self._children(folder) if f"/{by}=" in c]
