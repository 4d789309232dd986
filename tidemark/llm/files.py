"""Files that tasks write and read themselves, in any store that pyarrow reaches by its URI.

A file is written under a temporary name of the task attempt and then moved to its final name,
which depends on its content's place only. A repeated or speculative attempt therefore replaces a
file by an equal one, and a lost executor leaves at most a temporary file that no manifest lists.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ordering import running_totals
from tidemark.plans.materialize import materialize, shared_folder

#: Sampled rows for each shard when ranges are chosen; every so many of them is a bound.
SAMPLES_PER_SHARD = 32
ROW_BYTES = 64  # what a row counts besides its content


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder's URI of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path) if scheme else uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def replacing(folder: str, name: str) -> Iterator[pa.NativeFile]:
    """An output stream whose file appears as folder/name when the block ends without an error."""
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    temporary = f"{path}/_tmp-{uuid.uuid4().hex}-{name}"
    try:
        with files.open_output_stream(temporary, compression=None) as out:
            yield out
        files.move(temporary, f"{path}/{name}")
    except BaseException:
        if files.get_file_info(temporary).type == fs.FileType.File:
            files.delete_file(temporary)
        raise


def write_bytes(folder: str, name: str, data: bytes) -> None:
    with replacing(folder, name) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    files, path = store(uri)
    with files.open_input_stream(path, compression=None) as source:
        return source.read()


def open_file(uri: str) -> pa.NativeFile:
    files, path = store(uri)
    return files.open_input_file(path)


ORDER = ["_known", "_key", "_hash", "_more"]


def _packed(*columns: np.ndarray) -> np.ndarray:
    """Rows of ORDER as byte strings that compare like the rows."""
    out = np.empty((len(columns[0]), 25), np.uint8)
    out[:, 0] = columns[0]
    for i, c in enumerate(columns[1:]):
        unsigned = c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, 1 + 8 * i : 9 + 8 * i] = unsigned.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S25")


@dataclass
class _Dealer:
    """Where ranges begin, and the shards of ranges and of hot rows."""

    cuts: np.ndarray  # packed rows, ascending
    hot: np.ndarray  # whether only rows equal to the cut are meant
    first: np.ndarray  # first shard of a hot cut
    shard: np.ndarray  # of the range after each cut; [0] is the range before all
    shards: int

    def place(self, known, key, hash_, more) -> np.ndarray:
        """The shard of each row, -1 for hot rows."""
        rows = _packed(*(np.asarray(c) for c in (known, key, hash_, more)))
        at = np.searchsorted(self.cuts, rows, "right")
        out = self.shard[at]
        if len(self.cuts):
            before = np.maximum(at - 1, 0)
            out = np.where((at > 0) & self.hot[before] & (self.cuts[before] == rows), -1, out)
        return out.astype(np.int32)


def _dealer(bounds: list[tuple], hot: list[tuple]) -> tuple[_Dealer, list[tuple]]:
    """From range bounds and (row, parts) of hot rows; also (row, first shard, parts) of these."""
    parts, cuts = dict(hot), sorted({*bounds, *(row for row, _ in hot)})
    shard, first, number = [0], [], 0
    for cut in cuts:
        first.append(number + 1)
        number += 1 + parts.get(cut, 0)
        shard.append(number)
    packed = _packed(*(np.array(c, np.int64) for c in zip(*cuts, strict=True))) if cuts else np.empty(0, "S25")
    is_hot = np.array([c in parts for c in cuts], bool)
    return _Dealer(packed, is_hot, np.array(first), np.array(shard), number + 1), [(c, f, parts[c]) for c, f in zip(cuts, first, strict=True) if c in parts]


def _bounds(own: DataFrame, rows: int, shards: int) -> list[tuple]:
    """Quantiles of ORDER, one for each shard but the first, from rows that are chosen by their hash."""
    every = max(1, rows // (shards * SAMPLES_PER_SHARD))
    sample = materialize(own.where(F.pmod(F.xxhash64(*ORDER), F.lit(every)) == 0).select(*ORDER, F.lit(1).alias("_one")))
    per = -(-sample.count() // shards)
    if not per:
        return []
    line = running_totals(sample, ORDER, ["_one"]).where((F.col("before__one") > 0) & (F.col("before__one") % per == 0))
    return [tuple(r) for r in line.select(*ORDER).collect()]


def sorted_shards(
    df: DataFrame, key: str, content: Column, size: Column, shard_bytes: int, led_by: DataFrame | None = None
) -> tuple[DataFrame, int]:
    """Deal rows to shards that are consecutive ranges of `key`, and sort each shard.

    Adds `_shard` (int) and `_copies` (int, how many rows a row stands for). A task's rows are sorted by key, a hash
    of the content, and a hash of all columns, so rows that tie are equal. Shards depend on the rows alone, not on
    the files or partitions that they come from: bounds are quantiles of rows chosen by hash, of which the driver sees one a
    shard, and a row whose equals alone would overfill a shard becomes shards of its own, dealt by number. One
    shard is one task; null keys come first.

    Rows of `led_by` (same columns) are put before all rows of `df` with their key and content, and
    into each shard that has such rows.
    """

    def keyed(rows: DataFrame, more: Column) -> DataFrame:
        return rows.withColumns(
            {
                "_known": F.col(key).isNotNull().cast("int"),
                "_key": F.coalesce(F.col(key).cast("bigint"), F.lit(0)),
                "_hash": F.xxhash64(content),
                "_more": more,
            }
        )

    own = keyed(df, F.xxhash64(*df.columns))
    weight = F.coalesce(size, F.lit(0)).cast("bigint") + ROW_BYTES
    rows, total = own.agg(F.count(F.lit(1)), F.sum(weight)).first()
    shards = max(1, -(-(total or 0) // shard_bytes))
    bounds, hot = [], []
    if shards > 1:
        alike = own.groupBy(*ORDER).agg(F.sum(weight).alias("_bytes")).where(F.col("_bytes") > shard_bytes)
        hot = [(tuple(r[:4]), -(-r[4] // shard_bytes)) for r in alike.collect()]  # fewer than there are shards
        bounds = _bounds(own, rows, shards)
    dealer, hot_shards = _dealer(bounds, hot)

    @F.pandas_udf("int")
    def shard_of(known: pd.Series, key: pd.Series, content: pd.Series, more: pd.Series) -> pd.Series:
        return pd.Series(dealer.place(known, key, content, more), dtype="int32")

    one = F.lit(1).cast("int")
    dealt = own.withColumn("_shard", shard_of(*ORDER) if len(dealer.cuts) else F.lit(0)).withColumn("_copies", one)
    if hot_shards:
        table = own.sparkSession.createDataFrame([(*row, first, parts) for row, first, parts in hot_shards], "_known int, _key bigint, _hash bigint, _more bigint, _first int, _parts int")
        alike = dealt.where("_shard = -1").groupBy(*df.columns, *ORDER).agg(F.count(F.lit(1)).alias("_n"))
        each = alike.join(table, ORDER).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        copies = F.floor(F.col("_n") / F.col("_parts")) + (F.col("_part") < F.col("_n") % F.col("_parts")).cast("int")
        each = each.withColumns({"_shard": F.col("_first") + F.col("_part"), "_copies": copies.cast("int")}).where("_copies > 0")
        dealt = dealt.where("_shard >= 0").unionByName(each.select(*dealt.columns))
    dealt = dealt.withColumn("_led", F.lit(1))
    if led_by is not None:
        first = keyed(led_by, F.lit(-(1 << 63))).withColumns({"_copies": one, "_led": F.lit(0)})
        if len(dealer.cuts):
            # The smallest and the largest row with this key and content; a hot row's shards lie between.
            ends = [shard_of("_known", "_key", "_hash", F.lit(end).cast("bigint")) for end in (-(1 << 63), (1 << 63) - 1)]
            first = first.withColumn("_shard", F.explode(F.sequence(*ends)))
        else:
            first = first.withColumn("_shard", F.lit(0))
        dealt = dealt.unionByName(first)
    order = ["_known", "_key", "_hash", "_led", "_more"]
    return dealt.repartitionById(dealer.shards, F.col("_shard")).sortWithinPartitions(*order), dealer.shards
