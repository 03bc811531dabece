"""Outputs of one run that become visible together.

    base/run-<id>/<output>      what a run writes: as many tables as it likes
    base/_committed/<number>    one small file for each committed run: folder, outputs, notes

A run writes into a folder of its own and then puts one file in place, by a rename that
does not replace. Before the rename readers see all outputs of the run before it, after it
all of the new one; a run that dies leaves nothing but a folder that ``expire`` removes.
Of two runs that started from the same commit the second fails (``Conflict``): it has
read what is no longer the latest. On a store whose rename replaces or copies, give one
writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

LOG = "_committed"


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


@dataclass(frozen=True)
class Committed:
    number: int
    folder: str
    outputs: dict[str, str]
    notes: dict[str, Any] = field(default_factory=dict)

    def path(self, output: str) -> str:
        return self.outputs[output]


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder of a Hadoop file system; False, and nothing done, if ``target`` is there."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = hadoop.fs.Path(source), hadoop.fs.Path(target)
    fs = new.getFileSystem(conf)
    old, new = fs.makeQualified(old), fs.makeQualified(new)
    options = spark.sparkContext._gateway.new_array(getattr(hadoop.fs, "Options$Rename"), 0)  # none: do not replace
    try:
        hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(old, new, options)
    except Exception:
        if fs.exists(new):
            return False
        raise
    return True


class Run:
    """An open run: ``path`` names the folder of an output, ``commit`` makes all visible."""

    def __init__(self, commits: "Commits", number: int):
        self.commits, self.number = commits, number
        self.folder = f"{commits.base}/run-{uuid.uuid4().hex}"
        self.outputs: dict[str, str] = {}

    def path(self, output: str) -> str:
        return self.outputs.setdefault(output, f"{self.folder}/{output}")

    def commit(self, **notes: Any) -> Committed:
        self.commits._put(self.number, {"folder": self.folder, "outputs": self.outputs, "notes": notes})
        return Committed(self.number, self.folder, dict(self.outputs), notes)


class Commits:
    """The committed runs under a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._log = self._path(f"{self.base}/{LOG}")
        self._fs = self._log.getFileSystem(self._conf())

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, text: str):
        return self._hadoop.fs.Path(text)

    def numbers(self) -> list[int]:
        """Numbers of all commits that are kept, ascending."""
        if not self._fs.exists(self._log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._log)]
        return sorted(int(n) for n in names if n.isdigit())

    def _read(self, number: int) -> Committed:
        file = self._fs.open(self._path(f"{self.base}/{LOG}/{number:012d}"))
        try:
            raw = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        said = json.loads(raw)
        return Committed(number, said["folder"], said["outputs"], said["notes"])

    def latest(self) -> Committed | None:
        numbers = self.numbers()
        return self._read(numbers[-1]) if numbers else None

    def begin(self) -> Run:
        """A run that will follow the latest commit."""
        numbers = self.numbers()
        return Run(self, numbers[-1] + 1 if numbers else 1)

    def _put(self, number: int, said: dict) -> None:
        target, draft = self._path(f"{self.base}/{LOG}/{number:012d}"), self._path(f"{self.base}/{LOG}/_draft-{uuid.uuid4().hex}")
        file = self._fs.create(draft, False)
        try:
            file.write(bytearray(json.dumps(said).encode()))
        finally:
            file.close()
        if not rename_new(self.spark, draft.toString(), target.toString()):
            self._fs.delete(draft, False)
            raise Conflict(f"commit {number} of {self.base} is there already")

    def read(self, output: str, kind: str = "parquet", schema=None) -> DataFrame:
        """An output of the latest commit."""
        latest = self.latest()
        if latest is None:
            raise FileNotFoundError(f"nothing is committed under {self.base}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.format(kind).load(latest.path(output))

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the latest ``keep`` commits and every run folder that none of them
        names; call it when no run is open and no reader uses an older commit. Returns the
        folders' paths."""
        numbers = self.numbers()
        held = [self._read(n) for n in numbers[-keep:]] if keep > 0 else []
        text = json.dumps([[c.folder, c.outputs, c.notes] for c in held])
        for number in numbers[:len(numbers) - len(held)]:
            self._fs.delete(self._path(f"{self.base}/{LOG}/{number:012d}"), False)
        gone = []
        for status in self._fs.listStatus(self._path(self.base)) if self._fs.exists(self._path(self.base)) else []:
            name = status.getPath().getName()
            if name.startswith("run-") and f"{name}" not in text:
                self._fs.delete(status.getPath(), True)
                gone.append(f"{self.base}/{name}")
        return gone
