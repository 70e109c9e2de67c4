"""Runs of the governance tables appear whole or not at all.

A writer puts the rows of a run into folders of its own, ``<table>/run=<hash>/attempt=<id>``,
and then makes them known with one small file, ``commits/<hash>.<version>.json``. Readers open
the folders that the highest version of each run names and nothing else, so a run that
stopped between two tables, or is still being written, is invisible. A version can be claimed
once: of two writers the second takes the next one, and keeps what only the first may set.
The files also say when a run took place and which tables it judged: they are the index by which a
view over a long history opens the folders of the newest runs alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouch.sources.staging import remove

COMMITS = "commits"
_SCHEMA = "run_id string, run_time string, version int, tables map<string, string>, subjects array<string>"


@dataclass(frozen=True)
class Commit:
    """What is known of a run: its table folders, its time and the tables it judged."""

    run_id: str
    run_time: str = ""
    version: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    subjects: tuple[str, ...] = ()


def run_hash(run_id: str) -> str:
    return hashlib.md5(run_id.encode()).hexdigest()


def new_attempt(run_id: str) -> str:
    """A folder, below that of a table, that no other writer has."""
    return f"run={run_hash(run_id)}/attempt={uuid.uuid4().hex}"


def commit(
    spark: SparkSession,
    path: str,
    run_id: str,
    tables: dict[str, str],
    run_time: str = "",
    subjects: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    drop: tuple[str, ...] = (),
) -> Commit:
    """Make the folders of ``tables`` known as those of the run, in one step.

    Tables of an earlier version that are not among them stay as they were, as do those named
    in ``keep`` if the run has them already; ``drop`` takes tables from the run. Another writer
    that claims the same version first is no fault: the next version builds on its tables.
    """
    while True:
        known = committed(spark, path, run_id).get(run_id, Commit(run_id))
        kept = {n: f for n, f in known.tables.items() if n not in drop and (n not in tables or n in keep)}
        found = Commit(
            run_id, run_time or known.run_time, known.version + 1, {**tables, **kept}, tuple(sorted(subjects)) or known.subjects
        )
        if _claim(spark, path, f"{run_hash(run_id)}.{found.version:06d}.json", json.dumps(found.__dict__)):
            return found


def committed(spark: SparkSession, path: str, run_id: str | None = None) -> dict[str, Commit]:
    """The newest version of every run, or of one, by run id."""
    folder = f"{path}/{COMMITS}"
    pattern = f"{folder}/{run_hash(run_id)}.*.json" if run_id else f"{folder}/*.json"
    if not _listed(spark, pattern):
        return {}
    entries = spark.read.schema(_SCHEMA).json(pattern)
    newest = entries.groupBy("run_id").agg(F.max_by(F.struct("*"), "version").alias("c")).select("c.*")
    found = [Commit(r.run_id, r.run_time, r.version, r.tables or {}, tuple(r.subjects or ())) for r in newest.collect()]
    return {c.run_id: c for c in found if c.tables}


def newest_runs(commits: dict[str, Commit]) -> dict[str, Commit]:
    """The runs that are the last to have judged some table, by run id; of equal times, the greatest run id."""
    last: dict[str, Commit] = {}
    for found in commits.values():
        for subject in found.subjects:
            if subject not in last or (found.run_time, found.run_id) > (last[subject].run_time, last[subject].run_id):
                last[subject] = found
    return {c.run_id: c for c in last.values()}


def read_committed(spark: SparkSession, path: str, name: str, newest: bool = False) -> DataFrame:
    """The rows of a table in all committed runs, or in those that are the ``newest`` for some table."""
    commits = committed(spark, path)
    chosen = newest_runs(commits) if newest else commits
    folders = sorted(c.tables[name] for c in chosen.values() if name in c.tables)
    if not folders:
        # any run tells the columns
        folders = sorted(c.tables[name] for c in commits.values() if name in c.tables)[:1]
        if not folders:
            raise ValueError(f"no committed run has a table {name}")
        return spark.read.parquet(f"{path}/{name}/{folders[0]}").where("false")
    return spark.read.parquet(*[f"{path}/{name}/{f}" for f in folders])


def remove_abandoned(spark: SparkSession, path: str) -> int:
    """Delete the folders that no run names any more and the files of older versions; how many folders.

    Meant for a time at which nobody writes: folders of a run under way are not yet named either.
    """
    commits = committed(spark, path)
    named = {f"{name}/{folder}" for c in commits.values() for name, folder in c.tables.items()}
    gone = 0
    for folder in _listed(spark, f"{path}/*/run=*/attempt=*"):
        if "/".join(folder.rsplit("/", 3)[1:]) not in named:
            remove(spark, folder)
            gone += 1
    current = {f"{run_hash(c.run_id)}.{c.version:06d}.json" for c in commits.values()}
    for file in _listed(spark, f"{path}/{COMMITS}/*.json"):
        if file.rsplit("/", 1)[1] not in current:
            remove(spark, file)
    return gone


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found] if found is not None else []


def _claim(spark: SparkSession, path: str, name: str, text: str) -> bool:
    """Put ``text`` under a name that is not taken; False if it is.

    The file appears with all its contents. On a local disk a hard link does it, elsewhere a
    rename that refuses an existing name, which HDFS does in one step; a store without such
    a rename needs one writer at a time.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/{name}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/.{name}.{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        target = urlparse(files.makeQualified(place).toString())
        if target.scheme == "file":
            try:
                os.link(urlparse(files.makeQualified(draft).toString()).path, target.path)
            except FileExistsError:
                return False
            return True
        return not files.exists(place) and files.rename(draft, place)
    finally:
        files.delete(draft, False)
