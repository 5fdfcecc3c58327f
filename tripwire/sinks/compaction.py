"""Compaction of the fraud table's closed dates.

A stream writes small directories, one per batch and date.  ``compact`` rewrites
each closed date as one file (more when the date is large) and then names, in a
*manifest*, which directories are live:

    <table>/event_date=D/query_id=Q/batch_id=N/   written by batches
    <table>/_compacted/run=R/event_date=D/        the date's rows of the batches it covers
    <table>/_manifest/<version>.json              per date: the run, and the batches it covers

The newest manifest counts.  It is written beside its place and renamed to a
version that does not exist yet, so readers see the old state or the new one:
before the switch a run is not named, after it the batches it covers are ignored.
``vacuum`` removes what no reader needs any more.  A crash between any two steps
leaves every row readable exactly once, and repeating a step changes nothing.  A
batch repeated after its date was compacted writes its directory again; it stays
covered.  Batches that bring rows of a closed date later are live beside the run
until the next compaction.  One compaction of a table runs at a time; a second
one fails at the switch.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_RUNS, _MANIFEST = "_compacted", "_manifest"


class Folder:
    """Directory listing and small files of the store a table lives in."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, pattern: str, depth: int) -> list[list[str]]:
        """The last ``depth`` name parts of everything that fits the pattern."""
        found = self.fs.globStatus(self._path(pattern))
        return [str(s.getPath().toString()).split("/")[-depth:] for s in (found or [])]

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The file appears whole, or the call fails because it exists."""
        draft = self._path(f"{_MANIFEST}/.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(draft, self._path(name)):
            self.fs.delete(draft, False)
            raise RuntimeError(f"{name} was written by another compaction")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def manifest(folder: Folder) -> dict | None:
    """The newest manifest: ``version`` and ``dates`` (date -> run, covers: query id -> batch ids)."""
    versions = sorted(parts[0] for parts in folder.names(f"{_MANIFEST}/*.json", 1))
    return json.loads(folder.read(f"{_MANIFEST}/{versions[-1]}")) if versions else None


def _value(part: str) -> str:
    return part.split("=", 1)[1]


def _open(folder: Folder, dates: dict, day: str = "event_date=*") -> list[list[str]]:
    """Batch directories (date, query, batch) that no run covers."""
    return [parts for parts in folder.names(f"{day}/query_id=*/batch_id=*", 3)
            if int(_value(parts[2])) not in dates.get(_value(parts[0]), {}).get("covers", {}).get(_value(parts[1]), ())]


def live_rows(spark: SparkSession, root: str, stored: T.StructType, days: list[str] | None = None) -> DataFrame | None:
    """The live rows of a table that has a manifest (of the named ``event_date=...``
    directories).  None when the table has no manifest; zero rows when nothing is live."""
    folder = Folder(spark, root)
    known = manifest(folder)
    if known is None:
        return None
    dates = known["dates"]
    if days is None:
        batches, runs = _open(folder, dates), dates
    else:
        batches = [parts for day in days for parts in _open(folder, dates, day)]
        runs = {d: entry for d, entry in dates.items() if f"event_date={d}" in set(days)}
    out = []
    if batches:
        out.append(spark.read.schema(stored).option("basePath", folder.root)
                   .parquet(*[f"{folder.root}/{'/'.join(parts)}" for parts in batches]))
    if runs:
        schema = T.StructType([*stored.fields, T.StructField("run", T.StringType())])
        out.append(spark.read.schema(schema).option("basePath", f"{folder.root}/{_RUNS}")
                   .parquet(*[f"{folder.root}/{_RUNS}/run={e['run']}/event_date={d}" for d, e in runs.items()])
                   .select(*stored.names))
    if not out:
        return spark.createDataFrame([], stored)
    return out[0].unionByName(out[1]) if len(out) == 2 else out[0]


def compact(spark: SparkSession, root: str, before: date, stored: T.StructType) -> list[str]:
    """Rewrites the dates before ``before`` that batches wrote to since their last
    compaction; the dates rewritten."""
    folder = Folder(spark, root)
    known = manifest(folder) or {"version": 0, "dates": {}}
    dates = known["dates"]
    closed: dict[str, list[list[str]]] = {}
    for parts in _open(folder, dates):
        day = _value(parts[0])
        if day[:1].isdigit() and date.fromisoformat(day) < before:
            closed.setdefault(day, []).append(parts)
    if not closed:
        return []
    run = uuid.uuid4().hex
    batches = spark.read.schema(stored).option("basePath", folder.root).parquet(
        *[f"{folder.root}/{'/'.join(parts)}" for found in closed.values() for parts in found])
    earlier = {d: dates[d] for d in closed if d in dates}
    if earlier:
        schema = T.StructType([*stored.fields, T.StructField("run", T.StringType())])
        batches = batches.unionByName(
            spark.read.schema(schema).option("basePath", f"{folder.root}/{_RUNS}")
            .parquet(*[f"{folder.root}/{_RUNS}/run={e['run']}/event_date={d}" for d, e in earlier.items()]).select(*stored.names))
    (batches.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(f"{folder.root}/{_RUNS}/run={run}"))
    named = dict(dates)
    for day, found in closed.items():
        covers = {q: list(b) for q, b in dates.get(day, {}).get("covers", {}).items()}
        for _, query, batch in found:
            covers.setdefault(_value(query), []).append(int(_value(batch)))
        named[day] = {"run": run, "covers": {q: sorted(b) for q, b in covers.items()}}
    version = known["version"] + 1
    folder.publish(f"{_MANIFEST}/{version:010d}.json", json.dumps({"version": version, "dates": named}))
    return sorted(closed)


def vacuum(spark: SparkSession, root: str) -> None:
    """Removes covered batches, runs that the manifest does not name, and older
    manifests.  Reads that began before the last compaction must have ended."""
    folder = Folder(spark, root)
    known = manifest(folder)
    if known is None:
        return
    dates = known["dates"]
    still = set(map(tuple, _open(folder, dates)))
    for parts in folder.names("event_date=*/query_id=*/batch_id=*", 3):
        if tuple(parts) not in still:
            folder.delete("/".join(parts))
    for run, day in folder.names(f"{_RUNS}/run=*/event_date=*", 2):
        if dates.get(_value(day), {}).get("run") != _value(run):
            folder.delete(f"{_RUNS}/{run}/{day}")
    for (name,) in folder.names(f"{_MANIFEST}/*.json", 1):
        if name != f"{known['version']:010d}.json":
            folder.delete(f"{_MANIFEST}/{name}")
