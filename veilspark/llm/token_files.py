"""Token ids of documents in compressed files, and back.

Documents are put in ascending order over all tasks, encoded, and coded into files of
bounded size by the static coder of `rans`. A file is a row of a Parquet table, which
any store that Spark writes to can hold, and which is committed as a whole or not at all: its
place (part, file), the ids of its part before it, how many documents and ids it has, the documents' ids and
lengths, and the coded ids. Files, and blocks in a file, are decoded on their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.llm.common import in_chunks, partitions, running_start
from veilspark.llm.rans import compress, decompress
from veilspark.llm.tokens import default_tokenizer, encoder

FILE_TOKENS = 1 << 22
FILES = "part int, file int, before long, n_docs long, n_ids long, doc_ids array<long>, lengths array<long>, content binary"


def write_token_files(
    docs: DataFrame, path: str, end_id: int = 2, tokenizer: str | None = None, file_tokens: int = FILE_TOKENS
) -> None:
    """Write `docs` (doc_id, text; other columns are ignored) to token files under `path`.

    Order: doc_id, nulls first; equal ids by their text's hash. A null or empty text is the
    end id alone. A file closes behind the document that takes it to `file_tokens`.
    """
    tokens = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file = TaskContext.get().partitionId(), 0
        encode = encoder(tokens).encode
        end = np.array([end_id], "<u4").tobytes()
        keys, held, size, before = [], [], 0, 0
        for chunk in in_chunks(batches, "text"):
            for key, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist()):
                ids = encode(text or "") + end
                keys.append(key)
                held.append(ids)
                size += len(ids) // 4
                if size >= file_tokens:
                    yield _file(part, file, before, keys, held)
                    keys, held, size, file, before = [], [], 0, file + 1, before + size
        if keys:
            yield _file(part, file, before, keys, held)

    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, FILES).write.option("compression", "uncompressed").parquet(path)


def _file(part: int, file: int, before: int, keys: list, held: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(held), "<u4")
    row = {
        "part": (pa.int32(), part),
        "file": (pa.int32(), file),
        "before": (pa.int64(), before),
        "n_docs": (pa.int64(), len(keys)),
        "n_ids": (pa.int64(), len(ids)),
        "doc_ids": (pa.list_(pa.int64()), keys),
        "lengths": (pa.list_(pa.int64()), [len(x) // 4 for x in held]),
        "content": (pa.binary(), compress(ids)),
    }
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for kind, value in row.values()], list(row))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files under `path`: doc_id, start, n_tokens, ids_crc32 and ids.

    `start` counts the ids of all documents before; ids are little-endian unsigned 32-bit, and
    ids_crc32 is their unsigned CRC-32. A file with a damaged block fails. `with_ids=False`
    leaves the ids in the tasks that decode them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decompress(row["content"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                if ends[-1] != len(ids):
                    raise ValueError(f"file {row['part']}/{row['file']}: its ids and lengths differ")
                parts = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["part_start"] + row["before"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(list(map(zlib.crc32, parts)), pa.int64()),
                ]
                columns += [pa.array(parts, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    names = [part.split()[0] for part in schema.split(", ")]
    files = spark.read.schema(FILES).parquet(path)
    parts = running_start(files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")), "part", "n_ids", "part_start")
    starts = F.broadcast(parts.select("part", "part_start"))  # a row for each partition of the writer at most
    rows = files.select("part", "file", "before", "doc_ids", "lengths", "content").join(starts, "part")
    return rows.mapInArrow(run, schema)
