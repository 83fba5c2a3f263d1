"""The first lines of many files, read as a few KB of each.

A source of lines reads all of a file, whatever is asked of it. Here the files are listed as rows, by a source that
reads no content that is not asked for, and tasks open them and stop behind the lines that are wanted.
"""

from __future__ import annotations

import bz2
import gzip
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilspark.sources.scratch import materialise

FIRST_READ = 4096
#: The byte mark of UTF-8, and names of files that Spark unpacks by other codecs.
BYTE_MARK = b"\xef\xbb\xbf"
OTHER_CODECS = (".deflate", ".snappy", ".lz4", ".zst", ".zstd", ".lzo")


def head_lines_by_range(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None, rows: int, columns: dict[str, Column]
) -> DataFrame | None:
    """`_path`, `columns` of its metadata and `_lines`, up to `rows` first lines, of each file that has any; stored.

    None if tasks can't open some file by its path, as where pyarrow has no driver for the store: such heads
    have to be found by the source of lines.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path = F.col("_metadata.file_path").alias("_path")
    listed = reader.load(paths if isinstance(paths, str) else list(paths)).select(path, *[c.alias(n) for n, c in columns.items()])
    kinds = f"{', '.join(f'{name} {kind}' for name, kind in listed.dtypes)}, _lines array<binary>"
    heads = materialise(listed.mapInArrow(_reader(rows), kinds), "heads")
    if not heads.filter("_lines is null").isEmpty():
        return None
    text = F.transform("_lines", lambda line: line.cast("string"))
    return heads.filter(F.size("_lines") > 0).withColumn("_lines", text)


def _reader(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first_lines(path, rows) for path in batch.column("_path").to_pylist()]
            yield batch.append_column("_lines", pa.array(found, pa.list_(pa.binary())))

    return read


def first_lines(path: str, rows: int) -> list[bytes] | None:
    """Up to `rows` first lines of the file, as a source of lines would give them; None if it can't be opened here."""
    if path.lower().endswith(OTHER_CODECS):
        return None
    try:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_file(name) as file:
            if path.lower().endswith(".gz"):
                return _lines(gzip.GzipFile(fileobj=file).read, rows)
            if path.lower().endswith(".bz2"):
                return _lines(bz2.BZ2File(file).read, rows)
            return _lines(file.read, rows)
    except (OSError, EOFError, pa.ArrowException, ImportError):
        return None


def _lines(read: Callable[[int], bytes], rows: int) -> list[bytes]:
    """Lines end at CR, LF or both; one counts as whole once the next has begun or the file has ended."""
    held, size = b"", FIRST_READ
    while len(held.splitlines()) <= rows:
        more = read(size)
        if not more:
            break
        held, size = held + more, 2 * size
    return held.removeprefix(BYTE_MARK).splitlines()[:rows]
