"""Files as rows: listings without contents, and one output file for each input file.

Lines are written where they are: a task appends every gapless stretch of a file's lines to a
part of its own, so nothing is shuffled and no file is held in memory.  The table of parts is a
stage, which lists those of tasks that ended and none of lost or repeated attempts.  Publishing
then moves the only part of a file to its place, or joins its parts there in order, in blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.workspace import materialize

LISTED = "file string, file_bytes bigint, folder boolean"
FILES = "file string, file_bytes bigint"
PARTS = "layer string, path string, block_start bigint, row bigint, part string, bytes bigint, lines bigint, input_bytes bigint, terminated boolean"
PUBLISHED = "layer string, path string, output_bytes bigint, lines bigint, parts bigint"
#: Bytes of the mark that a text reader takes off the start of a file.
BYTE_ORDER_MARK = 3
#: Bytes copied at once where parts are joined.
BLOCK = 4 << 20


def store(place: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a place, which is a path or an address."""
    if place.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")
    if "://" in place:
        return pyarrow.fs.FileSystem.from_uri(place)
    return pyarrow.fs.LocalFileSystem(), place


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def list_files(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, file_bytes) of the matching files below ``root``, empty ones too; none without such a folder.

    Folders are listed by tasks, a level of the tree at a time; contents aren't read, and names
    that Spark's readers leave out are left out here.
    """
    scheme = root.split("://")[0] + "://" if "://" in root else ""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place in batch["file"]:
                system, path = store(place)
                found = system.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
                folders = [f.type == pyarrow.fs.FileType.Directory for f in found]
                kept = [
                    (scheme + f.path, None if folder else f.size, folder)
                    for f, folder in zip(found, folders)
                    if not _hidden(f.base_name) and (folder or fnmatchcase(f.base_name, glob))
                ]
                yield pd.DataFrame(kept, columns=["file", "file_bytes", "folder"]).astype({"file_bytes": "Int64", "folder": bool})

    level = spark.createDataFrame([(root.rstrip("/"),)], "file string")
    levels = []
    while True:
        below = materialize(level.mapInPandas(listed, LISTED), "listing")
        levels.append(below.where("NOT folder").select("file", "file_bytes"))
        level = below.where("folder").select("file")
        if level.isEmpty():
            break
        level = level.repartition("file")
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    return found


def write_parts(lines: DataFrame, folder: str, value: str) -> DataFrame:
    """Append the lines of ``value`` to parts below ``folder``; one row per part.

    ``lines`` has layer, path, block_start, row, line_bytes and file_bytes as the JSONL reader
    gives them.  A part holds consecutive rows of one file, so the parts of a file never
    interleave, in whatever order its rows arrive.  Null values are empty lines.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = store(folder)
        system.create_dir(place, recursive=True)
        out, head, rows = None, None, []
        size = count = taken = last = whole = 0

        def close() -> None:
            # the whole file, whose last line has no end
            bare = taken == whole + 1
            if not bare:
                out.write(b"\n")
            out.close()
            rows.append((*head, size + count - bare, count, taken, not bare))

        for batch in batches:
            if not batch.num_rows:
                continue
            layer, path, start, row, line_bytes, file_bytes, text = batch.columns
            ids = row.to_numpy(zero_copy_only=False)
            same = np.ones(len(ids), bool)
            for column in (layer, path, start):
                codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                same[1:] &= codes[1:] == codes[:-1]
            same[1:] &= ids[1:] == ids[:-1] + 1
            key = (layer[0].as_py(), path[0].as_py(), start[0].as_py())
            same[0] = head is not None and key == head[:3] and ids[0] == last + 1
            cuts = [0, *(np.flatnonzero(~same[1:]) + 1).tolist(), len(ids)]
            filled = pc.fill_null(text, "")
            for a, b in zip(cuts, cuts[1:]):
                if same[a]:
                    out.write(b"\n")
                else:
                    if out is not None:
                        close()
                    name = f"{uuid.uuid4().hex}.part"
                    head = (layer[a].as_py(), path[a].as_py(), start[a].as_py(), int(ids[a]), name)
                    out = system.open_output_stream(f"{place}/{name}", compression=None)
                    size = count = taken = 0
                    whole = file_bytes[a].as_py()
                piece = filled.slice(a, b - a)
                out.write("\n".join(piece.to_pylist()).encode())
                size += pc.sum(pc.binary_length(piece)).as_py()
                taken += pc.sum(line_bytes.slice(a, b - a)).as_py() + b - a
                count += b - a
            last = int(ids[-1])
            if rows and len(rows) >= 10_000:
                yield _batch(rows)
                rows.clear()
        if out is not None:
            close()
        if rows:
            yield _batch(rows)

    return lines.select(
        "layer", "path", "block_start", "row", "line_bytes", "file_bytes", value
    ).mapInArrow(written, PARTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PARTS.split(", ")]
    kinds = {"layer": pa.string(), "path": pa.string(), "part": pa.string(), "terminated": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names)


def publish(files: DataFrame, parts: DataFrame, folder: str, out_dir: str) -> DataFrame:
    """Put each of ``files`` (layer, path, file_bytes) below ``out_dir``; one row per file.

    The last line of a file ends as that of its input does; a file without lines becomes an
    empty one.  A task that runs again does its moves again: a part that is gone has been moved.
    """
    keys = ["layer", "path"]
    grouped = parts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("block_start", "row", "part", "bytes", "terminated"))).alias("pieces"),
        F.sum("lines").alias("lines"),
        F.sum("input_bytes").alias("input_bytes"),
    )
    joined = files.select(*keys, "file_bytes").join(grouped, keys, "left")

    def put(system, target, pieces, ends, place) -> int:
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        size = sum(p["bytes"] for p in pieces)
        if len(pieces) == 1 and pieces[0]["terminated"] == ends:
            source = f"{place}/{pieces[0]['part']}"
            if system.get_file_info(source).type == pyarrow.fs.FileType.NotFound:
                if system.get_file_info(target).size != size:
                    raise FileNotFoundError(f"{source} is gone, and {target} isn't it")
                return size
            if system.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
                system.delete_file(target)
            system.move(source, target)
            return size
        unwanted = bool(pieces) and pieces[-1]["terminated"] and not ends
        written = f"{place}/{uuid.uuid4().hex}.joined"
        with system.open_output_stream(written, compression=None) as out:
            for i, piece in enumerate(pieces):
                left = piece["bytes"] - (unwanted and i == len(pieces) - 1)
                with system.open_input_stream(f"{place}/{piece['part']}", compression=None) as source:
                    while left:
                        block = source.read(min(left, BLOCK))
                        out.write(block)
                        left -= len(block)
        if system.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
            system.delete_file(target)
        system.move(written, target)
        return size - unwanted

    def published(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, place = store(folder)
        system.create_dir(place, recursive=True)
        root = store(out_dir)[1].rstrip("/")
        for batch in batches:
            done = []
            for layer, path, file_bytes, pieces, lines, read in batch.itertuples(index=False, name=None):
                pieces = [] if pieces is None else list(pieces)
                ends = bool(pieces) and file_bytes - read in (0, BYTE_ORDER_MARK)
                size = put(system, f"{root}/{path}", pieces, ends, place)
                done.append((layer, path, size, int(lines) if pieces else 0, len(pieces)))
            yield pd.DataFrame(done, columns=[c.split()[0] for c in PUBLISHED.split(", ")])

    return joined.select(*keys, "file_bytes", "pieces", "lines", "input_bytes").mapInPandas(published, PUBLISHED)
