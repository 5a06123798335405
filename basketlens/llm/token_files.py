"""Documents as token ids in patched frame-of-reference files.

Texts are encoded where they are read. Documents are dealt by key ranges, each
range is sorted and written to one file by one task, and an index table holds
every file's id count. A file is written under a name of its attempt and then
renamed, so a task that runs again replaces it with the same bytes.

Defined cases: a null or empty text has only the end id; null keys come first
in a range of their own; equal keys are ordered by their ids; an empty table
gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.pfor import Reader, Writer
from basketlens.llm.pretokens import Units, bounded, slices, worker_store
from basketlens.sources.staging import Workspace

#: Documents a file holds on average, and the most files that are written.
FILE_ROWS, MAX_FILES = 4_096, 4_096
#: Entries of a worker's cache of encoded pre-tokens.
CACHE = 400_000
#: Texts that are encoded together, by number and bytes.
ENCODE_ROWS, ENCODE_BYTES = 8_192, 6 << 20
#: Output rows that are held together.
OUT_ROWS = 1_024


def encoded(texts: pa.Array, units: Units, end_id: int) -> list[bytes]:
    """Ids of each text and the end id, as bytes of an array of the file's dtype."""
    pretokens = bounded(worker_store().setdefault("pretokens", {}), CACHE)
    end = np.array([end_id], units.dtype).tobytes()
    return [ids + end for ids in units.encode_column(texts.cast(pa.string()).fill_null(""), pretokens)]


def _file_system(url: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(url if "://" in url or url.startswith("file:") else f"file://{url}")


def key_cuts(documents: DataFrame, key: str) -> list[int]:
    """Keys at which a new file begins; only their spacing is approximate."""
    n = documents.select(key).count()
    files = min(MAX_FILES, -(-n // FILE_ROWS))
    if files < 2:
        return []
    found = documents.where(F.col(key).isNotNull()).stat.approxQuantile(
        key, [i / files for i in range(1, files)], 0.1 / files
    )
    return sorted({int(c) for c in found})


def write_files(
    documents: DataFrame, vocabulary: str, end_id: int, folder: str, index: str,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the files below ``folder`` and return their table (file, path, n_docs, n_ids)."""
    cuts = key_cuts(documents, key)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units.opened(vocabulary)
        places = np.array(cuts, np.int64)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, n in slices(texts, ENCODE_ROWS, ENCODE_BYTES):
                part = keys[k : k + n]
                files = [0 if x is None else 1 + int(np.searchsorted(places, x, "right")) for x in part]
                ids = encoded(texts.slice(k, n), units, end_id)
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files, pa.int32()), pa.array(part, pa.int64()), pa.array(ids, pa.binary())],
                    ["file", "key", "ids"],
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = Units.opened(vocabulary).dtype
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        done, now, sink, writer, temporary = [], None, None, None, ""

        def close() -> None:
            if writer is not None:
                writer.finish()
                sink.close()
                system.move(temporary, f"{base}/{now:06d}.pfor")
                done.append((now, f"{folder}/{now:06d}.pfor", len(writer.documents), writer.n_ids))

        for batch in batches:
            for file, k, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if file != now:
                    close()
                    now, temporary = file, f"{base}/.{file:06d}.{uuid.uuid4().hex}"
                    sink = system.open_output_stream(temporary)
                    writer = Writer(sink)
                writer.add(k, np.frombuffer(ids, dtype))
        close()
        columns = list(zip(*done)) or [[], [], [], []]
        types = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["file", "path", "n_docs", "n_ids"]
        )

    coded = documents.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(
        encode, "file int, key bigint, ids binary"
    )
    dealt = coded.repartitionById(len(cuts) + 2, F.col("file")).sortWithinPartitions("file", "key", "ids")
    written = dealt.mapInArrow(write, "file int, path string, n_docs bigint, n_ids bigint")
    written.write.parquet(index)
    return documents.sparkSession.read.parquet(index)


def read_files(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over files in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = _file_system(path)
                with system.open_input_file(place) as source:
                    rows = []
                    for k, start, ids in Reader(source):
                        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
                        rows.append((k, before + start, len(ids), crc))
                        if len(rows) == OUT_ROWS:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], [key, "start", "n_tokens", "ids_crc32"]
        )

    # A row per file, at most MAX_FILES + 1 of them; each is read by a task of its own.
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", "path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    tasks = 1 + (files.agg(F.max("file")).first()[0] or 0)
    return placed.repartitionById(tasks, F.col("file")).select("path", "before").mapInArrow(
        read, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_file_digest(
    documents: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents to files in a workspace, and what reading them back gives."""
    space = Workspace(documents.sparkSession, "token-files")
    files = write_files(
        documents, vocabulary, end_id, space.path("files"), space.path("index"), key, text
    )
    return read_files(files, key)
