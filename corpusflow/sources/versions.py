"""Versioned tables as a data source: ``versions``, read and written by Spark's tasks.

A table is a folder with data files and one marker for each version, ``commit-N``, which
lists the files of that version. A marker appears whole or not at all, and never twice:
it is written under another name, and then takes its own by a step that fails where
that name is taken. Whenever a writer ends, readers see the version before or the new one;
of writers that expect the same version one wins and the others raise ``Conflict``.

That step is a hard link on file systems of the machine (local disks and mounted shared
folders) and a rename on those of Hadoop, which does not replace files there. Object stores
have neither: keep the markers elsewhere.

``versions`` writes through Python and needs a mounted folder; ``sinks.commit`` writes the
data with Spark's own writer to any file system of Hadoop. Both leave the same markers and
read each other's versions.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

_MARKER = re.compile(r"commit-(\d+)")


class Conflict(RuntimeError):
    """Another writer was first."""


def local(path: str) -> Path:
    """A folder of the machine."""
    scheme = re.match(r"(\w[\w+.-]*):", path)
    if scheme and scheme[1] != "file":
        raise ValueError(f"not a mounted folder: {path}")
    return Path(re.sub(r"^file:(//)?", "", path))


def said(text: str) -> dict | None:
    """What a marker says; None for one that its writer left unfinished."""
    if not text.strip():
        return None
    try:
        found = json.loads(text)
    except ValueError:
        found = {"data": text.strip()} if not text.lstrip().startswith("{") else None  # a path alone, as markers once were
    return found if isinstance(found, dict) and ("data" in found or "files" in found) else None


class Folder:
    """Markers in a mounted folder."""

    def __init__(self, path: str):
        self.root = local(path)

    def names(self) -> list[str]:
        return os.listdir(self.root) if self.root.is_dir() else []

    def text(self, name: str) -> str:
        return (self.root / name).read_text()

    def put(self, name: str, text: str) -> bool:
        """Whether ``name`` is now there with ``text``; False if it was there before."""
        self.root.mkdir(parents=True, exist_ok=True)
        own = self.root / f".{name}.{uuid.uuid4().hex}"
        try:
            with own.open("w") as out:
                out.write(text)
                out.flush()
                os.fsync(out.fileno())
            os.link(own, self.root / name)
        except FileExistsError:
            return False
        finally:
            own.unlink(missing_ok=True)
        return True


class HadoopFolder:
    """Markers in a folder of a file system of Hadoop, from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._at(""))] if self.fs.exists(self._at("")) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        own = self._at(f".{name}.{uuid.uuid4().hex}")
        out = self.fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            return not self.fs.exists(self._at(name)) and bool(self.fs.rename(own, self._at(name)))
        finally:
            self.fs.delete(own, False)


def folder(spark: SparkSession, path: str) -> Folder | HadoopFolder:
    """The markers of a table; those on the machine's own file systems by its own calls."""
    other = HadoopFolder(spark, path)
    return Folder(other._at("").toUri().getPath()) if other.fs.getScheme() == "file" else other


def latest(at: Folder | HadoopFolder) -> tuple[int, int]:
    """The newest version that can be read (0: none), and the highest number that is taken."""
    numbers = sorted((int(m[1]) for n in at.names() if (m := _MARKER.fullmatch(n))), reverse=True)
    return next((n for n in numbers if said(at.text(f"commit-{n}"))), 0), max(numbers, default=0)


def publish(at: Folder | HadoopFolder, expected: int, what: dict) -> int:
    """The number of the new version; raises ``Conflict`` unless ``expected`` is the newest."""
    now, taken = latest(at)
    if now != expected:
        raise Conflict(f"version {expected} is no longer the latest: {now} is")
    if not at.put(f"commit-{taken + 1}", json.dumps(what)):
        raise Conflict(f"version {taken + 1} was committed by another writer")
    return taken + 1


def marker(at: Folder | HadoopFolder, version: int | None) -> dict:
    """What the marker of a version says, by default of the newest."""
    version = latest(at)[0] if version is None else version
    found = said(at.text(f"commit-{version}")) if f"commit-{version}" in at.names() else None
    if found is None:
        raise FileNotFoundError(f"there is no version {version}")
    return found


# ------------------------------------------------------------------ the data source


@dataclass
class Part(WriterCommitMessage):
    """What a task has written."""

    file: str | None
    rows: int


class Writer(DataSourceArrowWriter):
    """Each task writes a file; the driver publishes them together, or deletes them."""

    def __init__(self, path: str, schema: T.StructType, expected: int):
        self.path, self.schema, self.expected, self.job = path, schema, expected, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        folder = local(self.path) / f"data-{self.job}"
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None  # an attempt's own name
        for batch in iterator:
            if out is None:
                folder.mkdir(parents=True, exist_ok=True)
                out = pq.ParquetWriter(folder / name, batch.schema, compression="zstd")
            out.write_batch(batch)
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Part(f"data-{self.job}/{name}" if out is not None else None, rows)

    def commit(self, messages: list[Part | None]) -> None:
        own = [m for m in messages if m is not None]
        publish(Folder(self.path), self.expected, {"files": sorted(m.file for m in own if m.file), "rows": sum(m.rows for m in own), "schema": self.schema.json()})

    def abort(self, messages: list[Part | None]) -> None:
        """Deletes all that the job's tasks have written, also attempts that sent no message.

        A task that still runs then may leave a file that no version lists: see ``vacuum``.
        """
        folder = local(self.path) / f"data-{self.job}"
        for p in folder.glob("*"):
            p.unlink(missing_ok=True)
        if folder.is_dir():
            folder.rmdir()


def vacuum(path: str, older: float = 7 * 86400, now: Callable[[], float] = time.time) -> list[str]:
    """Deletes data folders of a mounted table that no marker lists, untouched for ``older``
    seconds: what writers left that ended, or lost. A writer at work must be younger than that."""
    at, gone = Folder(path), []
    said_ = [said(at.text(n)) or {} for n in at.names() if _MARKER.fullmatch(n)]
    kept = {f.split("/")[0] for what in said_ for f in what.get("files", [])} | {what["data"].rstrip("/").split("/")[-1] for what in said_ if "data" in what}
    for folder in at.root.glob("data-*"):
        if folder.name not in kept and now() - max(p.stat().st_mtime for p in [folder, *folder.glob("*")]) >= older:
            for p in folder.glob("*"):
                p.unlink(missing_ok=True)
            folder.rmdir()
            gone.append(folder.name)
    return gone


class Reader(DataSourceReader):
    """A task for each file of a version."""

    def __init__(self, path: str, schema: T.StructType, files: list[str]):
        self.path, self.names, self.files = path, schema.names, files

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is not None and partition.value:
            yield from pq.ParquetFile(local(self.path) / partition.value).iter_batches(columns=self.names)


class StreamReader(DataSourceStreamReader):
    """The rows of versions in their order, each version once; the offset is the last one read.

    For a table whose versions each hold what is new. ``version_`` tells which.
    """

    def __init__(self, path: str, schema: T.StructType):
        self.path, self.names = path, [n for n in schema.names if n != "version_"]

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": latest(Folder(self.path))[0]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        at, out = Folder(self.path), []
        for n in range(start["version"] + 1, end["version"] + 1):
            what = said(at.text(f"commit-{n}")) if f"commit-{n}" in at.names() else None
            for f in files_of(self.path, what) if what else []:
                out.append(InputPartition((n, f)))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        version, file = partition.value
        for batch in pq.ParquetFile(local(self.path) / file).iter_batches(columns=self.names):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([version] * batch.num_rows, pa.int64())], names=[*batch.schema.names, "version_"])


def files_of(path: str, what: dict) -> list[str]:
    """Data files of a version in a mounted folder, whoever wrote it."""
    if "files" in what:
        return what["files"]
    return [str(p.relative_to(local(path))) for p in sorted((local(path) / what["data"]).glob("*.parquet"))]


class Versions(DataSource):
    """``spark.read.format("versions").load(path)``, option ``version``; ``df.write.format("versions")
    .option("expected", n).mode("append").save(path)``; ``spark.readStream`` gives the versions'
    rows in their order, with ``version_``."""

    @classmethod
    def name(cls) -> str:
        return "versions"

    def _marker(self) -> dict:
        version = self.options.get("version")
        found = marker(Folder(self.options["path"]), None if version is None else int(version))
        return found

    def schema(self) -> T.StructType:
        own = T.StructType.fromJson(json.loads(self._marker()["schema"]))
        return own.add("version_", T.LongType()) if self.options.get("stream") == "true" else own

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options["path"], schema, files_of(self.options["path"], self._marker()))

    def streamReader(self, schema: T.StructType) -> StreamReader:
        if "version_" not in schema.names:
            raise ValueError("option stream: true")
        return StreamReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if "expected" not in self.options:
            raise ValueError("option expected: the version that this one follows, 0 for the first")
        return Writer(self.options["path"], schema, int(self.options["expected"]))
