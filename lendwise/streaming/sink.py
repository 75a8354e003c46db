"""A table that a stream appends to batch by batch, of which readers see whole batches only (T5).

* ``<sink>/data/<folder>/kind=clean|dead``: the rows of one commit, written in one pass;
* ``<sink>/commits/<name>``: one small file per commit, published last (written under a hidden
  name, then renamed), that lists the commit's folders with their rows by kind and the commits that it replaces;
* ``<sink>/schema/<kind>``: the columns of each kind.

Rows of a folder that no commit lists are not there: a half-written batch is
invisible, and so is what a failed attempt left. A stream's commit is named by the
stream's id and the batch number, so a batch replayed after its commit changes nothing. Compaction writes the rows
of many commits to one folder and replaces them by one commit; names of replaced commits stay, so that
replays remain known. ``vacuum`` deletes what no reader can see.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwise.sources.files import listed, path_exists, publish, remove

CLEAN, DEAD = "clean", "dead"
KIND = "kind"


@dataclass
class Commit:
    name: str
    folders: dict[str, dict[str, int]] = field(default_factory=dict)  # folder -> rows by kind
    replaces: list[str] = field(default_factory=list)


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------- committing
    def declare(self, kind: str, schema: T.StructType) -> None:
        publish(self.spark, f"{self.path}/schema/{kind}", schema.json())

    def committed(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path}/commits/{name}")

    def commit(self, name: str, rows: DataFrame, observed: dict | None = None, drop: tuple[str, ...] = ()) -> dict:
        """Write ``rows`` (with a column ``kind``; null: not stored) without the columns ``drop`` and publish them under ``name``;
        an earlier commit of that name is replaced. Returns the values of ``observed`` (name -> aggregate), taken by the write."""
        seen, folder = Observation(), f"{name}-{uuid.uuid4().hex}"
        counts = [F.count_if(F.col(KIND) == k).alias(f"n_{k}") for k in (CLEAN, DEAD)]
        rows = rows.observe(seen, *counts, *[c.alias(k) for k, c in (observed or {}).items()])
        rows.where(F.col(KIND).isNotNull()).drop(*drop).write.partitionBy(KIND).parquet(f"{self.path}/data/{folder}")
        got = seen.get
        self._publish(Commit(name, {folder: {k: got[f"n_{k}"] for k in (CLEAN, DEAD) if got[f"n_{k}"]}}))
        return got

    def _publish(self, c: Commit) -> None:
        publish(self.spark, f"{self.path}/commits/{c.name}", json.dumps({"folders": c.folders, "replaces": c.replaces}))

    # ---------------------------------------------------------------- reading
    def commits(self) -> list[Commit]:
        """Commits that hold rows now, in the order of their names: all but the replaced ones."""
        if not listed(self.spark, f"{self.path}/commits"):
            return []
        files = self.spark.read.option("wholetext", True).text(f"{self.path}/commits").select("_metadata.file_name", "value").collect()
        found = [Commit(r["file_name"], **json.loads(r["value"])) for r in files]
        gone = {n for c in found for n in c.replaces}
        return sorted((c for c in found if c.name not in gone), key=lambda c: c.name)

    def read(self, kind: str = CLEAN) -> DataFrame:
        raw = self.spark.read.option("wholetext", True).text(f"{self.path}/schema/{kind}").first()["value"]
        schema = T.StructType.fromJson(json.loads(raw))
        paths = [f"{self.path}/data/{f}/{KIND}={kind}" for c in self.commits() for f, n in c.folders.items() if n.get(kind)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------ maintenance
    def compact(self, rows_per_file: int = 1_000_000, smaller_than: int = 1_000_000) -> str | None:
        """Put the rows of all commits below ``smaller_than`` rows into one folder; the commit's name, or None
        if fewer than two are so small. Batches that arrive meanwhile are not touched."""
        small = [c for c in self.commits() if sum(n for f in c.folders.values() for n in f.values()) < smaller_than]
        if len(small) < 2:
            return None
        name = f"compact-{uuid.uuid4().hex}"
        folders: dict[str, dict[str, int]] = {}
        for kind in (CLEAN, DEAD):
            parts = {f: n[kind] for c in small for f, n in c.folders.items() if n.get(kind)}
            if parts:
                n, folder = sum(parts.values()), f"{name}-{kind}"
                rows = self.spark.read.parquet(*[f"{self.path}/data/{f}/{KIND}={kind}" for f in parts])
                rows.coalesce(max(1, -(-n // rows_per_file))).write.parquet(f"{self.path}/data/{folder}/{KIND}={kind}")
                folders[folder] = {kind: n}
        self._publish(Commit(name, folders, [c.name for c in small] + [old for c in small for old in c.replaces]))
        return name

    def vacuum(self) -> int:
        """Delete the folders that no commit lists; the number deleted. Only while nothing is being written
        and no reader still holds an earlier list."""
        used = {f for c in self.commits() for f in c.folders}
        unused = [f for f in listed(self.spark, f"{self.path}/data") if f not in used]
        for f in unused:
            remove(self.spark, f"{self.path}/data/{f}")
        return len(unused)
