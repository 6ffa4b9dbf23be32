"""Token ids in files of independent zstandard frames with a seek table at the end.

A file holds documents in ascending id order: one frame for each document (its ids, little-endian,
of the width in the index), one frame with the index (an Arrow stream: doc_id, n_tokens), and a
skippable frame with the seek table of the public zstd seekable format: compressed size,
decompressed size and checksum (low half of XXH64 of the content) of each frame. A reader seeks
to the frames it wants and decompresses only these; any zstd tool can unpack the whole file.

Documents are ranged by id and sorted in each range; range i is file i. A task writes under a
name of its own attempt and renames when done, and the same rows give the same bytes, so a task
that runs again does no harm. The driver sees one row a file.

Nulls: a null text is an empty one, whose only token is the end id; null ids come first. Rows
with the same id stand in the order of their texts. An empty table gives no files and an empty
result. Other columns are not read. A document is one frame, however long its text is.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.encoding import SLICE_BYTES, encoder_for
from sedimenta.llm.words import column, lean, slices

END = 2

# Fixed values of the public seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

_MANIFEST = "file string, part int, n_documents long, n_tokens long"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = folder.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class FrameWriter:
    """Frames and their seek table, written to a file that only grows."""

    def __init__(self, sink, level: int = 3) -> None:
        self.sink = sink
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.entries: list[bytes] = []

    def frame(self, content: bytes) -> None:
        packed = self.compressor.compress(content)
        self.sink.write(packed)
        check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.entries.append(struct.pack("<III", len(packed), len(content), check))

    def close(self) -> None:
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Single frames of a file, each checked as it is read."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a file with a seek table")
        source.seek(size - 9 - 12 * count)
        self.table = np.frombuffer(source.read(12 * count), dtype="<u4").reshape(count, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        self.source.seek(int(self.offsets[i]))
        content = self.decompressor.decompress(self.source.read(int(self.table[i, 0])))
        if len(content) != self.table[i, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return content

    def index(self) -> pa.Table:
        return pa.ipc.open_stream(self.frame(len(self.table) - 1)).read_all()


def _index(ids: list, counts: list[int], width: int) -> bytes:
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64())})
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema.with_metadata({"width": str(width)})) as out:
        out.write_table(table)
    return sink.getvalue()


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode each whole text, append `end_id`, and write the files below `folder`. `tokenizer`
    is the path of a tokenizer file; its content (a vocabulary, of a few MB) goes to the
    executors as a broadcast. Lazy: rows (file, part, n_documents, n_tokens) as files are made."""
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as source:
        model = spark.sparkContext.broadcast(source.read())
    count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = texts.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = encoder_for(model.value), TaskContext.get()
        end = np.array([end_id], dtype=f"<u{encoder.width}").tobytes()
        store, root = _store(folder)
        name = f"part-{context.partitionId():05d}.tokens.zst"
        draft = f"{root}/.{name}.{context.taskAttemptId()}"
        ids, counts, writer, sink = [], [], None, None
        for part in slices(batches, most=SLICE_BYTES):
            if writer is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(draft, compression=None)
                writer = FrameWriter(sink)
            coded, at = encoder.encode_texts(column(part, "text"))
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                writer.frame(coded[a:b].tobytes() + end)
                counts.append(b - a + 1)
            ids += column(part, "doc_id").to_pylist()
        if writer is None:
            return
        writer.frame(_index(ids, counts, encoder.width))
        writer.close()
        sink.close()
        store.move(draft, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict(
            {
                "file": pa.array([f"{folder}/{name}"]),
                "part": pa.array([context.partitionId()], pa.int32()),
                "n_documents": pa.array([len(ids)], pa.int64()),
                "n_tokens": pa.array([sum(counts)], pa.int64()),
            }
        )

    return ranged.mapInArrow(lean(run, caches=False), _MANIFEST)


def read_documents(file: str, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the wanted documents of one file, or of all; other frames stay packed."""
    store, path = _store(file)
    chosen = None if wanted is None else set(wanted)
    with store.open_input_file(path) as source:
        reader = FrameReader(source)
        index = reader.index()
        width = int(index.schema.metadata[b"width"])
        for i, doc in enumerate(index.column("doc_id").to_pylist()):
            if chosen is None or doc in chosen:
                yield doc, np.frombuffer(reader.frame(i), dtype=f"<u{width}").astype("<u4")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row a document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), and with `with_ids` the
    ids themselves."""
    spark: SparkSession = manifest.sparkSession
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = placed.select("file", "start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(column(batch, "file").to_pylist(), column(batch, "start").to_pylist(), strict=True):
                rows: list[tuple] = []
                held = 0
                for doc, ids in read_documents(file):
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), ids if with_ids else None))
                    start += len(ids)
                    held += len(ids) if with_ids else 1
                    if held > 200_000:
                        yield _rows(rows, with_ids)
                        rows, held = [], 0
                yield _rows(rows, with_ids)

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("ids", pa.list_(pa.int32()))] * with_ids
    values = list(zip(*rows, strict=True)) if rows else [[]] * 5
    if with_ids:
        values[4] = [v.astype(np.int32) for v in values[4]]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kind) for v, (_, kind) in zip(values, kinds, strict=False)], names=[n for n, _ in kinds]
    )
