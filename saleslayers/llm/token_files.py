"""Token ids as flat binary files with 64-bit document offsets, written by partitions and read back by memory map.

A folder holds, for each partition p in ascending document order, part-p.ids (unsigned little-endian
integers, 16 bits if the vocabulary fits, else 32), part-p.offsets (64-bit, one more than documents:
where each document begins within the part, and the end) and part-p.docs (64-bit document ids). The
place of a part among all ids is the prefix sum of the sizes before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.llm.common import qualified
from saleslayers.llm.tokens import encoder

DTYPES = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


@dataclass(frozen=True)
class Part:
    number: int
    docs: int
    ids: int
    width: int
    base: int = 0


#: Stands for a null document id in a file, and reads back as null.
NO_ID = -(1 << 63)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a qualified folder, and the path on it."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class _Writer:
    """The three files of one part, streamed; they take their names only once whole, so a lost task leaves none."""

    KINDS = ("ids", "offsets", "docs")

    def __init__(self, folder: str, number: int) -> None:
        self._fs, self._root = _opened(folder)
        self._fs.create_dir(self._root, recursive=True)
        self._name, self._attempt = f"part-{number:05d}", uuid.uuid4().hex
        self._files = {k: self._fs.open_output_stream(self._path(k, True)) for k in self.KINDS}
        self._files["offsets"].write(np.zeros(1, "<u8").tobytes())
        self.docs = self.ids = 0

    def _path(self, kind: str, pending: bool) -> str:
        return f"{self._root}/.{self._name}.{kind}.{self._attempt}" if pending else f"{self._root}/{self._name}.{kind}"

    def write(self, doc_ids: np.ndarray, ids: list[np.ndarray]) -> None:
        ends = self.ids + np.cumsum([len(x) for x in ids], dtype=np.uint64)
        self._files["ids"].write(np.concatenate(ids).tobytes())
        self._files["offsets"].write(ends.astype("<u8").tobytes())
        self._files["docs"].write(doc_ids.astype("<i8").tobytes())
        self.docs += len(ids)
        self.ids = int(ends[-1])

    def close(self) -> None:
        for kind in self.KINDS:
            self._files[kind].close()
            self._fs.move(self._path(kind, True), self._path(kind, False))


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> list[Part]:
    """Writes the ids of all texts, each with the end id, in ascending document order; gives the list of parts.

    Null texts are empty and hold the end id alone; repeated rows are written as often as they
    occur (by text within an id); a null document id comes first and is written as NO_ID, the least
    64-bit integer; an id that is no number counts as null; no rows write no parts. A folder without a
    scheme is on Spark's default file system. Texts are sorted before they are encoded, so ids are never shuffled, and a
    task holds a batch of documents at a time. The driver gets one small row per part.
    """
    folder = qualified(docs.sparkSession, folder)
    number_of = F.coalesce(F.col(id_col).try_cast("long"), F.lit(NO_ID))
    rows = docs.select(number_of.alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, number = encoder(tokenizer), None, TaskContext.get().partitionId()
        end = np.array([end_id], dtype=enc.dtype)
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or _Writer(folder, number)
            ids = enc.encode(batch.column(1))
            out.write(batch.column(0).to_numpy(), [np.concatenate([x, end]) for x in ids])
        if out:
            out.close()
            sizes = [[number], [out.docs], [out.ids], [enc.dtype.itemsize]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in sizes], ["number", "docs", "ids", "width"])

    found = rows.mapInArrow(put, "number long, docs long, ids long, width long").collect()
    parts, base = [], 0
    for row in sorted(found):
        parts.append(Part(row.number, row.docs, row.ids, row.width, base))
        base += row.ids
    return parts


def open_part(folder: str, part: Part, kind: str) -> np.ndarray:
    """A file of a part as an array: memory-mapped on a local or mounted disk, else read."""
    files, root = _opened(folder)
    path = f"{root}/part-{part.number:05d}.{kind}"
    dtype = {"ids": DTYPES[part.width], "offsets": np.dtype("<u8"), "docs": np.dtype("<i8")}[kind]
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_ids(spark: SparkSession, folder: str, parts: list[Part], rows_at_once: int = 1024) -> DataFrame:
    """One row per document from the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers, whatever the file's width.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not parts:
        return spark.createDataFrame([], schema)
    folder = qualified(spark, folder)
    by_number = {p.number: p for p in parts}
    numbers = [p.number for p in parts]

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                part = by_number[numbers[i]]
                ids, offsets, doc_ids = (open_part(folder, part, k) for k in ("ids", "offsets", "docs"))
                for a in range(0, part.docs, rows_at_once):
                    b = min(a + rows_at_once, part.docs)
                    at = offsets[a : b + 1].astype(np.int64)
                    crc = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(at[:-1], at[1:])]
                    ids_here = doc_ids[a:b].astype(np.int64)
                    columns = [pa.array(ids_here, mask=ids_here == NO_ID), *(pa.array(c, pa.int64()) for c in (at[:-1] + part.base, np.diff(at), crc))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(get, schema)
