"""The record of a run: which steps are done, on which inputs, and where their tables are.

A run has a folder of its own below `<root>/_runs`, with one small JSON file set per finished
step, written and read by Spark, so it may lie in any store.  A run that was not published is
open: the next run of the same root on the same inputs goes on with it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "run string, step string, key string, tables string, counts string, as_of string"
PUBLISHED = "published"


def fingerprint(*frames: DataFrame) -> str | None:
    """A digest of the files behind the frames: their paths, lengths and times of change
    (their contents are not read).  None where a frame has no files."""
    parts = []
    for df in frames:
        files = df.inputFiles()
        if not files:
            return None
        listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
        row = listed.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*listed.columns)).alias("x")).first()
        parts.append(f"{row['n']}:{row['x']}")
    return hashlib.sha256(";".join(parts).encode()).hexdigest()


def step_key(*parts: object) -> str | None:
    """The key of a step from what it depends on; None (never reused) if a part is unknown."""
    return None if any(p is None for p in parts) else hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


@dataclass
class Manifest:
    spark: SparkSession
    root: str
    run: str
    steps: dict[str, dict] = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, root: str, as_of: dt.date | None) -> "Manifest":
        """The open run of a root, or a new one.  An open run that was asked for another
        fixed day is left, and a new one begun."""
        folder = f"{root.rstrip('/')}/_runs"
        spark.createDataFrame([], ENTRY).write.mode("append").json(folder)  # makes the folder
        # one row per step of each run
        rows = spark.read.schema(ENTRY).option("recursiveFileLookup", True).json(folder).collect()
        latest = max((r["run"] for r in rows), default=None)
        steps = {r["step"]: r.asDict() for r in rows if r["run"] == latest}
        same_day = as_of is None or all(s["as_of"] in (None, str(as_of)) for s in steps.values())
        if latest is None or PUBLISHED in steps or not same_day:
            now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmssSSS")).first()[0]
            return cls(spark, folder, now)
        return cls(spark, folder, latest, steps)

    def day(self) -> dt.date | None:
        """The day that the open run was begun on."""
        days = [s["as_of"] for s in self.steps.values() if s["as_of"]]
        return dt.date.fromisoformat(days[0]) if days else None

    def done(self, step: str, key: str | None) -> dict | None:
        """Tables and counts of a finished step with this key."""
        entry = self.steps.get(step)
        if entry is None or key is None or entry["key"] != key:
            return None
        return {"tables": json.loads(entry["tables"]), "counts": json.loads(entry["counts"])}

    def add(self, step: str, key: str | None, tables: dict[str, str], counts: dict[str, int], as_of: dt.date | None) -> None:
        row = {"run": self.run, "step": step, "key": key, "tables": json.dumps(tables), "counts": json.dumps(counts),
               "as_of": None if as_of is None else str(as_of)}
        self.spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("overwrite").json(f"{self.root}/{self.run}/{step}")
        self.steps[step] = row
