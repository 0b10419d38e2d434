"""Token ids as binary files with Elias-Fano document boundaries.

A file holds the ids of consecutive documents end to end, at two bytes an id where the vocabulary
allows it. Where each document begins is an ascending sequence, so it is stored in Elias-Fano form:
the low bits of every value side by side, the high bits as a unary bit vector, and the places of
every 256th set bit, from which any offset is found without a table of 64-bit offsets. The ascending
doc_ids are stored in the same form.

Layout, little-endian: ``HEADER``, then the Elias-Fano sections of the doc_ids and of the
boundaries, then the ids.

Files are written by tasks under names of their own; the written table of files (the manifest) is
what commits them, so a file that a lost or repeated task leaves behind is never read. Order is
ascending doc_id (rows without one first, then equal ids by the hash of their text).

Defined results: a null or empty text has the end id alone; an empty table writes no file and reads
back as no rows. Values of repeated ids are kept, one per row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.units import library_memo, slices
from ledgerloom.session import scratch_path

MAGIC = b"EFTOKENS"
#: magic, bytes per id, documents, documents without a doc_id, least doc_id, ids, bytes of the two sections
HEADER = struct.Struct("<8sqqqqqqq")
SAMPLE = 256
#: Ids after which a file is closed, so that a writer's memory doesn't follow its partition.
FILE_IDS = 4_000_000


@dataclass(frozen=True)
class EliasFano:
    """An ascending sequence of integers from 0 on."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: np.ndarray  # bit position of each SAMPLE-th set bit

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            return EliasFano(0, 0, b"", b"", np.zeros(0, np.uint64))
        low_bits = max(0, int((int(values[-1]) + 1) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        unary = np.zeros(int(at[-1]) + 1, np.uint8)
        unary[at.astype(np.int64)] = 1
        pack = lambda b: np.packbits(b.ravel(), bitorder="little").tobytes()
        return EliasFano(n, low_bits, pack(bits), pack(unary), at[::SAMPLE])

    def _low(self, first: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - first, np.uint64)
        begin, stop = first * self.low_bits, end * self.low_bits
        raw = np.frombuffer(self.low, np.uint8)[begin // 8 : (stop + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[begin % 8 : begin % 8 + stop - begin].reshape(-1, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def block(self, b: int) -> np.ndarray:
        """Values ``b * SAMPLE`` to the next sample, by selecting set bits from the sampled place on."""
        first, end = b * SAMPLE, min(self.n, (b + 1) * SAMPLE)
        start = int(self.samples[b])
        stop = int(self.samples[b + 1]) if b + 1 < len(self.samples) else 8 * len(self.high)
        raw = np.frombuffer(self.high, np.uint8)[start // 8 : (stop + 7) // 8]
        ones = np.flatnonzero(np.unpackbits(raw, bitorder="little")[start % 8 :])[: end - first] + start
        return ((ones.astype(np.uint64) - np.arange(first, end, dtype=np.uint64)) << np.uint64(self.low_bits)) | self._low(first, end)

    def get(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.block(i // SAMPLE)[i % SAMPLE])

    def all(self) -> np.ndarray:
        return np.concatenate([self.block(b) for b in range(len(self.samples))]) if self.n else np.zeros(0, np.uint64)

    def to_bytes(self) -> bytes:
        return struct.pack("<qqqqq", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)) + self.low + self.high + self.samples.astype("<u8").tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> EliasFano:
        n, low_bits, low, high, samples = struct.unpack_from("<qqqqq", raw)
        at = struct.calcsize("<qqqqq")
        return EliasFano(n, low_bits, raw[at : at + low], raw[at + low : at + low + high], np.frombuffer(raw, "<u8", samples, at + low + high))


def file_bytes(doc_ids: list[int | None], packed: list[bytes], width: int) -> bytes:
    """One file; ``doc_ids`` ascend with the missing ones first, ``packed`` are 32-bit ids."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    least = known[0] if known else 0
    bounds = np.cumsum([0, *(len(p) // 4 for p in packed)])
    ids = np.frombuffer(b"".join(packed), "<u4")
    if width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("an id doesn't fit into two bytes")
    sections = [EliasFano.of(np.array([d - least for d in known], np.uint64)).to_bytes(), EliasFano.of(bounds).to_bytes()]
    head = HEADER.pack(MAGIC, width, len(doc_ids), nulls, least, len(ids), *map(len, sections))
    return head + b"".join(sections) + ids.astype("<u2" if width == 2 else "<u4").tobytes()


class TokenFile:
    """A file read back. ``ids(i)`` reads the ids of one document only."""

    def __init__(self, raw: bytes):
        magic, self.width, self.docs, self.nulls, self.least, self.n_ids, a, b = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        self._doc_ids = EliasFano.from_bytes(raw[at : at + a])
        self.bounds = EliasFano.from_bytes(raw[at + a : at + a + b])
        self._ids = np.frombuffer(raw, "<u2" if self.width == 2 else "<u4", self.n_ids, at + a + b)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [int(v) + self.least for v in self._doc_ids.all().tolist()]

    def ids(self, i: int) -> np.ndarray:
        return self._ids[self.bounds.get(i) : self.bounds.get(i + 1)]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, place of its first id in the file, ids) of every document."""
        bounds = self.bounds.all().astype(np.int64).tolist()
        for doc, start, end in zip(self.doc_ids(), bounds, bounds[1:], strict=False):
            yield doc, start, self._ids[start:end]


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def qualified(spark, folder: str) -> str:
    """``folder`` with the scheme that the session would use for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


MANIFEST = "shard long, part int, path string, docs long, ids long"


def write_files(df: DataFrame, folder: str, width: int = 2, file_ids: int = FILE_IDS, path: str | None = None, end_id: int | None = None) -> DataFrame:
    """Write (doc_id, packed ids) in the order of ``df``'s partitions and rows; returns the manifest.

    With ``path``, the second column is text, which is encoded by that file's library, and ``end_id``
    is added to each document.

    Asking for the manifest's rows writes the files: save it once, then read files by the saved rows.
    """
    folder = qualified(df.sparkSession, folder)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        docs: list[int | None] = []
        packed: list[bytes] = []
        held, number = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal docs, packed, held, number
            path = f"{root}/{task.partitionId()}-{number}-{task.taskAttemptId()}.eft"
            with store.open_output_stream(path) as out:
                out.write(file_bytes(docs, packed, width))
            row = [[task.partitionId()], [number], [path], [len(docs)], [held]]
            docs, packed, held, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int64()), pa.array(row[1], pa.int32()), pa.array(row[2]), pa.array(row[3], pa.int64()), pa.array(row[4], pa.int64())],
                ["shard", "part", "path", "docs", "ids"])

        end = b"" if end_id is None else struct.pack("<I", end_id)
        for part in (rows for batch in parts for rows in slices(batch)):
            bodies = part.column(1).to_pylist()
            for doc, body in zip(part.column(0).to_pylist(), library_memo(path).pack(bodies) if path else bodies, strict=True):
                ids = body + end
                docs.append(doc)
                packed.append(ids)
                held += len(ids) // 4
                if held >= file_ids:
                    yield close()
        if docs:
            yield close()

    return df.mapInArrow(write, MANIFEST)


def with_base(manifest: DataFrame) -> DataFrame:
    """Each file with the number of ids before it: a running sum over one row per file."""
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files of a saved manifest: doc_id, start, n_tokens, ids_crc32."""
    folder = qualified(manifest.sparkSession, folder)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for part in parts:
            for path, base in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                with store.open_input_stream(path) as raw:
                    file = TokenFile(raw.read())
                rows = [(doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, start, ids in file.documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A number of its own, as adaptive execution would merge so small a table into one task.
    files = with_base(manifest).select("path", "base").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text), sorted by doc_id over all partitions."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).withColumn("_tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")


def store_documents(docs: DataFrame, path: str, end_id: int = 2, width: int = 2, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Encode ``docs`` into files in the shared folder; returns the saved manifest and the folder."""
    spark = docs.sparkSession
    folder, saved = scratch_path(spark, "token-files"), scratch_path(spark, "token-manifest")
    write_files(in_order(docs, doc_id, text), folder, width, path=path, end_id=end_id).write.parquet(saved)
    return spark.read.schema(MANIFEST).parquet(saved), folder
