"""ZIP archives as rows, one row per CSV line.

Archives are read where they lie, by the tasks: first only their tables of contents, then each
wanted entry as a stream. Nothing holds a whole archive or entry in memory, and the entries of
one archive are read by different tasks. An entry counts whole or not at all: one that is damaged or
encrypted is left out and never fails the others.

Tasks open paths through Arrow, with the credentials that Arrow finds on its machine (environment
or instance role); Spark's own file system settings do not reach them.
"""

from __future__ import annotations

import io
import shutil
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.sources.landing import list_files, route

CSV = "csv"
SKIPPED = "skipped"
UNREADABLE = "unreadable"
LANDED = "landed"
CORRUPT = "corrupt"

#: What a damaged, cut off, encrypted or unknown kind of entry raises.
_BAD_ENTRY = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, ValueError)

_LINES_PER_BATCH = 8192


def file_system_of(path: str):
    """Arrow's file system for a path (local, HDFS, object stores) and the path on it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith(("file:", "/")):
        return LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _open(path: str):
    """A seekable stream."""
    file_system, name = file_system_of(path)
    return file_system.open_input_file(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it: "/x" is on the default one, not the local disk."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, version in zip(batch["source_zip"], batch["version"]):
            try:
                with _open(path) as stream, zipfile.ZipFile(stream) as archive:
                    # A later entry of the same name replaces an earlier one.
                    sizes = {i.filename: i.file_size for i in archive.infolist() if not i.is_dir()}
            except (zipfile.BadZipFile, ValueError):  # ValueError: too short to seek in
                yield pd.DataFrame({"source_zip": [path], "version": [version], "entry": [None], "size": [None], "status": [UNREADABLE]})
                continue
            names = list(sizes)
            yield pd.DataFrame(
                {
                    "source_zip": path,
                    "version": version,
                    "entry": names,
                    "size": [sizes[n] for n in names],
                    "status": [CSV if n.endswith(".csv") and "/" not in n else SKIPPED for n in names],
                }
            )


def _entry_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, entry in zip(batch["source_zip"], batch["entry"]):
            if _defect(path, entry):
                continue
            with _open(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(entry) as raw:
                numbers, lines = [], []
                for number, line in enumerate(io.TextIOWrapper(raw, "utf-8", errors="replace"), start=1):
                    numbers.append(number)
                    lines.append(line.rstrip("\n"))
                    if len(lines) == _LINES_PER_BATCH:
                        yield pd.DataFrame(
                            {"source_zip": path, "entry": entry, "line_no": numbers, "line": lines}
                        )
                        numbers, lines = [], []
                if lines:
                    yield pd.DataFrame({"source_zip": path, "entry": entry, "line_no": numbers, "line": lines})


def _defect(path: str, entry: str) -> str | None:
    """Why an entry cannot be read to its end and checksum, or nothing."""
    try:
        with _open(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(entry) as raw:
            while raw.read(1 << 20):
                pass
    except _BAD_ENTRY as error:
        return f"{type(error).__name__}: {error}"[:500]
    return None


def _land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copies each entry to its target, which takes its name only once it is whole. A target that has its name
    was landed by an earlier attempt and stays."""
    for batch in batches:
        for row in batch.itertuples():
            target_system, target = file_system_of(row.target)
            status, reason = LANDED, None
            if target_system.get_file_info(target).is_file:
                yield pd.DataFrame({"source_zip": [row.source_zip], "entry": [row.entry], "target": [row.target], "status": [status], "reason": [reason]})
                continue
            target_system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            folder, name = target.rsplit("/", 1)
            pending = f"{folder}/_{name}.{uuid.uuid4().hex}"
            try:
                with _open(row.source_zip) as stream, zipfile.ZipFile(stream) as archive, archive.open(row.entry) as raw:
                    with target_system.open_output_stream(pending) as out:
                        shutil.copyfileobj(raw, out, 1 << 20)
                target_system.move(pending, target)
            except _BAD_ENTRY as error:
                status, reason = CORRUPT, f"{type(error).__name__}: {error}"[:500]
                if target_system.get_file_info(pending).is_file:
                    target_system.delete_file(pending)
            yield pd.DataFrame({"source_zip": [row.source_zip], "entry": [row.entry], "target": [row.target], "status": [status], "reason": [reason]})


def land_entries(entries: DataFrame, tasks: int | None = None) -> DataFrame:
    """Copies entries (source_zip, entry, target) out of their archives: with status and reason of each.

    The copies are made when the result is computed; computing it again makes the same files.
    """
    spread = entries.select("source_zip", "entry", "target").repartition(tasks or _tasks(entries.sparkSession))
    return spread.mapInPandas(_land, "source_zip STRING, entry STRING, target STRING, status STRING, reason STRING")


def _tasks(spark: SparkSession) -> int:
    # One entry is the unit of work. The number is given because these rows are tiny: left to
    # adaptive execution they would all be put into one task.
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def archive_contents(spark: SparkSession, folder: str) -> DataFrame:
    """source_zip, entry, size and status of every entry of the `.zip` files below a folder, and version, which
    tells an archive from an earlier one at the same path.

    status is "csv" for top-level CSV files, "skipped" for other entries and "unreadable" (with
    no entry) for a file that is no ZIP archive.
    """
    listed = list_files(spark, folder, "*.zip")
    archives = listed.select(F.col("path").alias("source_zip"), F.md5(F.concat_ws("|", "path", "modified", "size")).alias("version"))
    return archives.mapInPandas(_contents, "source_zip STRING, version STRING, entry STRING, size LONG, status STRING")


def expand_archives(
    spark: SparkSession, folder: str, *, category: str | None = None, tasks: int | None = None
) -> DataFrame:
    """source_zip, entry, category, line_no and line of all top-level CSV entries.

    Entries of no known category keep a NULL category. With `category`, only entries of that
    one are opened. `tasks` is the number of tasks that
    share the entries, by default as many as a shuffle has or the cluster runs at a time.
    """
    wanted = archive_contents(spark, folder).filter(F.col("status") == CSV).select("source_zip", "entry")
    if category:
        wanted = wanted.filter(route(F.col("entry")) == category)
    spread = wanted.repartition(tasks or _tasks(spark))
    lines = spread.mapInPandas(_entry_lines, "source_zip STRING, entry STRING, line_no LONG, line STRING")
    return lines.select("source_zip", "entry", route(F.col("entry")).alias("category"), "line_no", "line")


def data_lines(lines: DataFrame, category: str) -> DataFrame:
    """The lines of one category without the header lines."""
    return lines.filter((F.col("category") == category) & (F.col("line_no") > 1))
