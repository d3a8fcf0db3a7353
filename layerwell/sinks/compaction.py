"""Compaction of a day planned by bytes: small files are packed into bins, large files are neither read nor moved.

Files below the target are sorted by size and put into the fullest bin they fit in (best fit); a bin of one file is left alone.
Footers do not count, since a merged file has one only and in small files they outweigh the rows; the footer of the smallest file
stands for all. Each bin becomes one file, written to the shared folder first. The swap is a short list of renames and deletes that is stored
in the partition before it starts, in a file that readers skip. Whoever compacts the day next, or calls ``finish_compaction``, completes a
swap that was cut off; every step may be repeated. A reader that lists the folder during the swap may see a row twice or not at
all, as with any overwrite of a plain folder.
"""

from __future__ import annotations

import bisect
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from layerwell.session import scratch_path
from layerwell.sinks.catalog import describe_table
from layerwell.specs import TableSpec

TARGET_BYTES = 128 * 1024**2
PLAN_FILE = "_compaction.json"


@dataclass(frozen=True)
class Compaction:
    """What a compaction did: files and bytes of the day before and after, and the files it read."""

    files_before: int
    files_after: int
    bytes_before: int
    bytes_after: int
    files_read: int


def plan_bins(sizes: Mapping[str, int], target: int = TARGET_BYTES) -> list[list[str]]:
    """Files smaller than the target, best fit by decreasing size; only bins of two files or more."""
    bins: list[list[str]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    for name in sorted((n for n, s in sizes.items() if s < target), key=lambda n: (-sizes[n], n)):
        at = bisect.bisect_left(room, (sizes[name], -1))
        if at == len(room):
            bins.append([])
            left, number = target, len(bins) - 1
        else:
            left, number = room.pop(at)
        bins[number].append(name)
        bisect.insort(room, (left - sizes[name], number))
    return [b for b in bins if len(b) > 1]


class _Folder:
    """A partition's folder on any file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.system = self.at().getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def sizes(self) -> dict[str, int]:
        """Data files and their bytes."""
        if not self.system.exists(self.at()):
            return {}
        found = {f.getPath().getName(): f.getLen() for f in self.system.listStatus(self.at()) if f.isFile()}
        return {n: s for n, s in found.items() if not n.startswith(("_", "."))}

    def footer_bytes(self, name: str, size: int) -> int:
        """Bytes of a Parquet file behind its rows; the footer's length is stored before the last four bytes."""
        stream = self.system.open(self.at(name))
        try:
            stream.seek(size - 8)
            length = int.from_bytes(stream.readInt().to_bytes(4, "big", signed=True), "little")
        finally:
            stream.close()
        return min(size, length + 8)

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, spark: SparkSession, name: str) -> str | None:
        if not self.system.exists(self.at(name)):
            return None
        stream = self.system.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _folder(spark: SparkSession, spec: TableSpec, dt: str) -> _Folder:
    place = describe_table(spark, spec.qualified).where("col_name = 'Location'").first().data_type
    return _Folder(spark, f"{place.rstrip('/')}/dt={dt}")


def _swap(folder: _Folder, plan: dict) -> None:
    """Show the new files, then remove the old ones, then the plan; each step may have been done before."""
    for name in plan["add"]:
        if folder.system.exists(folder.at(f"_{name}")):
            folder.system.rename(folder.at(f"_{name}"), folder.at(name))
    for name in plan["remove"]:
        folder.system.delete(folder.at(name), False)
    folder.system.delete(folder.at(PLAN_FILE), False)


def finish_compaction(spark: SparkSession, spec: TableSpec, dt: str) -> bool:
    """Complete a swap that was cut off; False if there is none."""
    folder = _folder(spark, spec, dt)
    stored = folder.read(spark, PLAN_FILE)
    if stored is None:
        return False
    _swap(folder, json.loads(stored))
    return True


def compact_planned(spark: SparkSession, spec: TableSpec, dt: str, target: int = TARGET_BYTES) -> Compaction:
    """Merge the small files of a day into files of about ``target`` bytes.

    The plan holds one entry per file of the day on the driver. Rows are counted before and after writing; a difference is an
    error and leaves the day as it was.
    """
    finish_compaction(spark, spec, dt)
    folder = _folder(spark, spec, dt)
    before = folder.sizes()
    smallest = min(before, key=before.get, default=None)
    footer = folder.footer_bytes(smallest, before[smallest]) if smallest and 8 <= before[smallest] < target else 0
    bins = plan_bins({name: size - footer for name, size in before.items()}, target - footer)
    read = [name for b in bins for name in b]
    if bins:
        schema = spec.schema.fields
        data = spark.read.schema(type(spec.schema)([f for f in schema if f.name not in spec.partition_by]))
        rows = data.parquet(*(f"{folder.path}/{name}" for name in read))
        place = spark.createDataFrame([(name, i) for i, b in enumerate(bins) for name in b], "_file string, _bin int")
        named = rows.withColumn("_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).join(place, "_file").drop("_file")
        staged = scratch_path(spark, "compact")
        # One task and one file per bin: rows are dealt by the bin's number, and written apart by it.
        named.repartition(max(1, len(bins)), "_bin").write.partitionBy("_bin").parquet(staged)
        if spark.read.parquet(staged).count() != rows.count():
            raise RuntimeError(f"{spec.qualified} {dt}: the copy in {staged} differs, nothing was replaced")
        mark = uuid.uuid4().hex[:8]
        added = []
        for i in range(len(bins)):
            part = _Folder(spark, f"{staged}/_bin={i}")
            for n, name in enumerate(sorted(part.sizes())):
                new = f"part-{mark}-{i:05d}-{n}{name[name.index('.'):]}"
                _bring(folder, part.at(name), new)
                added.append(new)
        folder.write(PLAN_FILE, json.dumps({"add": added, "remove": read}))
        _swap(folder, {"add": added, "remove": read})
        spark.catalog.refreshTable(spec.qualified)
    after = folder.sizes()
    return Compaction(len(before), len(after), sum(before.values()), sum(after.values()), len(read))


def _bring(folder: _Folder, source, name: str) -> None:
    """Put a staged file into the folder under a name that readers skip."""
    conf = folder.system.getConf()
    util, target = folder.jvm.org.apache.hadoop.fs.FileUtil, folder.at(f"_{name}")
    util.copy(source.getFileSystem(conf), source, folder.system, target, False, True, conf)
