"""Token ids in files: frequency ranks in 1 to 4 bytes, their lengths apart in control bytes.

An id is stored as its rank by frequency in the whole corpus (0 the most frequent, ties by id), little-endian in as few
bytes as it needs. Four lengths share a control byte, two bits each from the lowest, length less one. Lengths are found
by a table over the 256 control bytes, values by one gather per length, so decoding has no loop over ids.

A folder holds `data/*.tok`, `manifest/` (Parquet: the valid files in order) and `ranks/` (Parquet: rank, id). A file is
a run of blocks of whole documents; a block is
    magic 8 bytes | documents, ids, data bytes: 3 x int64 | doc_id int64 each | 1 where doc_id is null, uint8 each
    | ids per document int64 each | control bytes | data bytes
Files are written under a name of their own by each task attempt and count only once they are in the manifest, which
Spark commits; what a lost or repeated task leaves is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.store import saved

MAGIC = b"MTOK\x00\x01\r\n"
BLOCK_IDS = 1 << 20
FILE_IDS = 1 << 25
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    keep = np.arange(4) <= extra[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[keep]
    quads = np.concatenate([extra, np.zeros(-len(extra) % 4, np.uint8)]).reshape(-1, 4)
    return (quads << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    source, out = np.frombuffer(data, np.uint8), np.zeros(count, np.uint32)
    for byte in range(4):
        has = lengths > byte
        if not has.any():
            break
        out[has] |= source[starts[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


def _block(ids: list[int | None], parts: list[np.ndarray]) -> bytes:
    ranks = np.concatenate(parts)
    control, data = pack(ranks)
    return b"".join([
        MAGIC, np.array([len(ids), len(ranks), len(data)], "<i8").tobytes(),
        np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(),
        np.array([len(p) for p in parts], "<i8").tobytes(), control, data])


def blocks(stream) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc ids, ids per document, ranks) of each block of an open file."""
    while head := stream.read(len(MAGIC)):
        if head != MAGIC:
            raise ValueError("not a token file, or cut off")
        documents, count, size = np.frombuffer(stream.read(24), "<i8").tolist()
        ids = np.frombuffer(stream.read(8 * documents), "<i8").tolist()
        null = np.frombuffer(stream.read(documents), np.uint8)
        lengths = np.frombuffer(stream.read(8 * documents), "<i8")
        control, data = stream.read(-(-count // 4)), stream.read(size)
        yield [None if n else i for i, n in zip(ids, null)], lengths, unpack(control, data, count)


def _writer(folder: str, ranks: np.ndarray):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/data", recursive=True)
        packer = Packer()
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        done, stream, path, ids, parts, held, in_file, documents = [], None, "", [], [], 0, 0, 0

        def flush():
            nonlocal stream, path, ids, parts, held, in_file, documents
            if not ids:
                return
            if stream is None:
                path = f"data/part-{part:06d}-{len(done):05d}-{attempt}.tok"
                stream = store.open_output_stream(f"{root}/{path}")
            stream.write(_block(ids, parts))
            in_file, documents, ids, parts, held = in_file + held, documents + len(ids), [], [], 0

        def close():
            nonlocal stream, in_file, documents
            flush()
            if stream is not None:
                stream.close()
                done.append((part, len(done), path, documents, in_file))
                stream, in_file, documents = None, 0, 0

        for batch in batches:
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = ranks[packer.unpack(packed.as_py())]
                ids.append(doc_id)
                parts.append(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    flush()
                    if in_file >= FILE_IDS:
                        close()
        close()
        columns = list(zip(*done)) if done else [[], [], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["part", "seq", "path", "documents", "ids"])

    return write


class Packer:
    """Ids as compressed bytes: 2 or 4 bytes an id, the first byte says which."""

    def __init__(self):
        import zstandard

        self.compressor, self.decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def pack(self, ids: np.ndarray) -> bytes:
        kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
        return bytes([int(kind[2])]) + self.compressor.compress(ids.astype(kind).tobytes())

    def unpack(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(self.decompressor.decompress(packed[1:]), f"<u{packed[0]}")


def tokenised(docs: DataFrame, tokens, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of every whole text, `end_id` last, as Packer packs them. tokens: see WordTokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, packer = np.array([end_id], np.uint32), tokens.here(), Packer()
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            packed = [packer.pack(np.concatenate([ids, last])) for ids in own.encode_column(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        encode, "doc_id long, packed binary")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, packer = np.zeros(0, np.int64), Packer()
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            ids = [packer.unpack(packed.as_py()) for packed in batch.column(1).slice(at, 1024)]
            own = np.bincount(np.concatenate(ids), minlength=len(total))
            own[:len(total)] += total
            total = own
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])


def write_tokens(docs: DataFrame, folder: str, tokens, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text of docs and write the files of `folder` in ascending order of doc_id.

    Null ids come first; rows of one id are ordered by their ids' bytes. Null texts count as empty: the end id alone.
    Every text is encoded once; its ids are cut from the lineage, counted, ordered by range and written. What reaches
    the driver is one count per id of the vocabulary.
    """
    spark = docs.sparkSession
    encoded = saved(tokenised(docs, tokens, end_id, id_col, text_col), "ids")
    counted = encoded.mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ordered = sorted((-row["n"], row["id"]) for row in counted.toLocalIterator())
    by_rank = np.array([i for _, i in ordered], np.int64)
    ranks = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 0, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(by_rank)], "rank int, id long").coalesce(1).write.parquet(
        f"{folder}/ranks")
    dealt = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "packed")
    dealt.mapInArrow(_writer(folder, ranks),
                     "part int, seq int, path string, documents long, ids long").write.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian uint32 bytes) of each document in the files."""
    by_rank = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").toLocalIterator()], "<u4")
    manifest = spark.read.parquet(f"{folder}/manifest")
    placed = manifest.withColumn("start", F.sum("ids").over(Window.orderBy("part", "seq")) - F.col("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{root}/{path}") as stream:
                    for doc_ids, lengths, ranks in blocks(stream):
                        ids, ends = by_rank[ranks], np.cumsum(lengths)
                        texts = [ids[end - n:end].tobytes() for end, n in zip(ends.tolist(), lengths.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths, pa.int64()),
                             pa.array(texts, pa.binary())], ["doc_id", "start", "ids"])
                        start += int(ends[-1])

    files = max(1, manifest.count())
    return placed.select("path", "start").repartition(files, "path").mapInArrow(read, "doc_id long, start long, ids binary")
