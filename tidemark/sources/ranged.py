"""Tables that are rewritten one range of days at a time.

A write puts the rows of its days into a folder of its own. When all files are there, a manifest with the
next number is published, which says from which folder each range of days is read; nothing that
an earlier manifest names is touched. Readers use the manifest with the highest number, so they see the
table before a write or after it and never in between, and a run that dies leaves only files
that no manifest names. Of two writers at once, the second finds the number taken, and applies its range
to the manifest that it finds then.

    root/manifests/0000000007.json      {"ranges": [{"folder": "...", "start": "...", "end": "..."}, ...]}
    root/data/<folder>/part-*.parquet

The manifest has a range for each write that still counts: it grows with the number of writes, not of rows or days.
A write over all days brings it back to one range.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_DAY = timedelta(days=1)
TRIES = 20


@dataclass(frozen=True, order=True)
class Span:
    """The days from start to end, both included, that are read from a folder."""

    start: date
    end: date
    folder: str

    def without(self, start: date, end: date) -> list[Span]:
        """What is left of the days when start..end is cut out."""
        if end < self.start or self.end < start:
            return [self]
        left = [Span(self.start, start - ONE_DAY, self.folder)] if self.start < start else []
        return left + ([Span(end + ONE_DAY, self.end, self.folder)] if end < self.end else [])


def replaced(spans: Sequence[Span], new: Span) -> list[Span]:
    """The ranges after a write of `new`, by day; neighbours from one folder become one."""
    cut = sorted([*(part for s in spans for part in s.without(new.start, new.end)), new])
    out: list[Span] = []
    for span in cut:
        if out and out[-1].folder == span.folder and out[-1].end + ONE_DAY == span.start:
            out[-1] = Span(out[-1].start, span.end, span.folder)
        else:
            out.append(span)
    return out


def _literal(day: date) -> Column:
    """A date literal from its text, which also holds for the first and the last day there is."""
    return F.lit(day.isoformat()).cast("date")


class RangedTable:
    """A table at `root` whose rows belong to days by the date column `day`."""

    def __init__(self, spark: SparkSession, root: str, day: str = "date"):
        self.spark, self.root, self.day = spark, root.rstrip("/"), day
        self._jvm = spark._jvm
        self._files = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def versions(self) -> list[int]:
        """Numbers of the published manifests, ascending."""
        folder = self._path("manifests")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))

    def exists(self) -> bool:
        return bool(self.versions())

    def spans(self, version: int | None = None) -> list[Span]:
        """The ranges of a version (the newest one without a number)."""
        version = version if version is not None else next(reversed(self.versions()), None)
        if version is None:
            return []
        # The file is one line, read by Spark's own reader, so any store that Spark reads will do.
        text = self.spark.read.text(f"{self.root}/manifests/{version:010d}.json", wholetext=True).first()[0]
        return [Span(date.fromisoformat(r["start"]), date.fromisoformat(r["end"]), r["folder"]) for r in json.loads(text)["ranges"]]

    def _publish(self, version: int, spans: Sequence[Span]) -> bool:
        """Write a manifest under a temporary name and move it to its number; False if the number is taken."""
        rows = [{"folder": s.folder, "start": s.start.isoformat(), "end": s.end.isoformat()} for s in spans]
        final, temporary = self._path(f"manifests/{version:010d}.json"), self._path(f"manifests/_{uuid.uuid4().hex}")
        out = self._files.create(temporary, False)
        try:
            out.write(bytearray(json.dumps({"ranges": rows}).encode()))
        finally:
            out.close()
        # A rename onto an existing file fails or is refused, depending on the store.
        if not self._files.exists(final) and self._files.rename(temporary, final):
            return True
        self._files.delete(temporary, False)
        return False

    def replace(self, rows: DataFrame, start: date, end: date, order: Sequence[str] = ()) -> None:
        """Make `rows` of start..end the rows of these days; days of the range without rows become empty.

        Rows outside the range, or without a day, are left out. Files hold spans of days, so that a filter on
        the day skips the others by statistics.
        """
        if start > end:
            raise ValueError("start must not be after end")
        folder = uuid.uuid4().hex
        own = rows.where(F.col(self.day).between(_literal(start), _literal(end)))
        clustered = own.repartitionByRange(self.day).sortWithinPartitions(self.day, *order)
        clustered.write.parquet(f"{self.root}/data/{folder}")
        for _ in range(TRIES):
            newest = next(reversed(self.versions()), 0)
            if self._publish(newest + 1, replaced(self.spans(newest or None), Span(start, end, folder))):
                return
        raise RuntimeError(f"{self.root}: other writers took {TRIES} manifest numbers")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version. Each folder is read once, with its ranges as a filter on the day."""
        spans = self.spans(version)
        if not spans:
            raise FileNotFoundError(f"{self.root} has no manifest")
        by_folder: dict[str, list[Span]] = {}
        for span in spans:
            by_folder.setdefault(span.folder, []).append(span)
        parts = []
        for folder, own in by_folder.items():
            days = [F.col(self.day).between(_literal(s.start), _literal(s.end)) for s in own]
            parts.append(self.spark.read.parquet(f"{self.root}/data/{folder}").where(reduce(lambda a, b: a | b, days)))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the newest `keep` manifests and the folders that these do not name. Not while
        a write or a read of an older version is under way."""
        versions = self.versions()
        named = {s.folder for v in versions[-keep:] for s in self.spans(v)}
        for version in versions[:-keep]:
            self._files.delete(self._path(f"manifests/{version:010d}.json"), False)
        gone = []
        for status in self._files.listStatus(self._path("data")) if versions else []:
            if status.getPath().getName() not in named:
                self._files.delete(status.getPath(), True)
                gone.append(status.getPath().getName())
        return sorted(gone)
