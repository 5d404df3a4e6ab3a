"""Token ids in a compressed binary format: patched frame-of-reference blocks.

A chunk holds whole documents in ascending doc_id order, ids end to end. Its ids are cut into blocks of 128. A block stores its minimum, a bit width chosen so that 90 % of the
differences to the minimum fit, and the low bits of all differences at that width; the differences that do not
fit (outliers) go to an exception list as position and high bits. An index has each block's start, so any block
can be read alone. All numbers are little-endian unsigned.

    chunk   magic "PFR1" | documents u32 | ids u64 | blocks u32
            | per document: doc_id i64, id is null u8, ids u32
            | block starts u32 (blocks + 1, from the end of the index) | blocks
    block   minimum u32 | width u8 | exceptions u8 | packed low bits (16 * width bytes)
            | exceptions: position u8 | exceptions: high bits u32

Spark's Parquet writer carries the chunks as a binary column, one row a chunk: its commit protocol makes a lost
executor's half-written files invisible, and any store Spark can write to will do.

NULL texts are empty and hold the end id only. A NULL doc_id sorts first; repeated doc_ids are kept in the order
of their texts. An empty table gives an empty one. Further columns are not stored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.bpe import BYTES_AT_ONCE, vocabulary
from riskspark.llm.text import pieces, utf8

BLOCK = 128
PERCENTILE = 0.9
IDS_PER_CHUNK = 1 << 18
MAGIC = b"PFR1"
DOCUMENT = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of eight numbers a row, end to end from the lowest: `width` bytes a row."""
    words = np.zeros((len(values), width // 8 + 2), np.uint64)
    values = values.astype(np.uint64) & np.uint64((1 << width) - 1)
    for k in range(8):
        word, shift = divmod(k * width, 64)
        words[:, word] |= values[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").view(np.uint8).reshape(len(values), -1)[:, :width]


def _unpacked(rows: np.ndarray, width: int) -> np.ndarray:
    """Eight numbers of `width` bits from each row of `width` bytes."""
    data = np.zeros((len(rows), 8 * (width // 8 + 2)), np.uint8)
    data[:, :width] = rows
    words, out = data.view("<u8"), np.empty((len(rows), 8), np.int64)
    for k in range(8):
        word, shift = divmod(k * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        out[:, k] = value & np.uint64((1 << width) - 1)
    return out


def _places(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For blocks with these many exceptions end to end: each exception's block, and its number in it."""
    block = np.repeat(np.arange(len(count)), count)
    return block, np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Block starts (one more for the end) and the blocks. The last block is filled up with its last id."""
    if not len(ids):
        return np.zeros(1, np.uint32), b""
    full = np.pad(ids.astype(np.int64), (0, -len(ids) % BLOCK), mode="edge").reshape(-1, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    at = int(np.ceil(percentile * BLOCK)) - 1
    # Bits that the difference at the percentile needs: the exponent of a whole number below 2^53.
    width = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1].astype(np.int64)
    high = rest >> width[:, None]
    block, where = np.nonzero(high)
    wrong = np.bincount(block, minlength=len(full))
    starts = np.concatenate([[0], np.cumsum(6 + BLOCK // 8 * width + 5 * wrong)])
    begin = starts[:-1]
    out = np.zeros(starts[-1], np.uint8)
    out[begin[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[begin + 4], out[begin + 5] = width, wrong
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        out[begin[own][:, None] + 6 + np.arange(BLOCK // 8 * w)] = _packed(rest[own].reshape(-1, 8), w).reshape(len(own), -1)
    if len(block):
        number = _places(wrong)[1]
        first = begin[block] + 6 + BLOCK // 8 * width[block]
        out[first + number] = where
        out[(first + wrong[block] + 4 * number)[:, None] + np.arange(4)] = high[block, where].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts.astype(np.uint32), out.tobytes()


def unpack(starts: np.ndarray, blocks: bytes, n: int) -> np.ndarray:
    """The `n` ids of the blocks."""
    if not n:
        return np.empty(0, np.uint32)
    flat = np.frombuffer(blocks, np.uint8)
    begin = starts[:-1].astype(np.int64)
    low = np.ascontiguousarray(flat[begin[:, None] + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)
    width, wrong = flat[begin + 4].astype(np.int64), flat[begin + 5].astype(np.int64)
    out = np.zeros((len(begin), BLOCK), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        rows = flat[begin[own][:, None] + 6 + np.arange(BLOCK // 8 * w)]
        out[own] = _unpacked(rows.reshape(-1, w), w).reshape(len(own), BLOCK)
    if wrong.any():
        block, number = _places(wrong)
        first = begin[block] + 6 + BLOCK // 8 * width[block]
        high = np.ascontiguousarray(flat[(first + wrong[block] + 4 * number)[:, None] + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)
        out[block, flat[first + number]] += high << width[block]
    return (out + low[:, None]).reshape(-1)[:n].astype(np.uint32)


def chunk_bytes(docs: np.ndarray, ids: np.ndarray) -> bytes:
    starts, blocks = pack(ids)
    return MAGIC + struct.pack("<IQI", len(docs), len(ids), len(starts) - 1) + docs.tobytes() + starts.astype("<u4").tobytes() + blocks


def read_chunk(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The document records and all ids of a chunk."""
    if data[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    n_docs, n_ids, n_blocks = struct.unpack_from("<IQI", data, 4)
    at = 20
    docs = np.frombuffer(data, DOCUMENT, n_docs, at)
    at += n_docs * DOCUMENT.itemsize
    starts = np.frombuffer(data, "<u4", n_blocks + 1, at)
    return docs, unpack(starts, data[at + 4 * len(starts) :], n_ids)


def _chunks(path: str, end_id: int, per_chunk: int):
    """For mapInArrow over one sorted partition: rows of chunks, each up to the document that fills it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        part, seq, waiting = 0, 0, 0
        docs: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def chunk() -> pa.RecordBatch:
            data = chunk_bytes(np.concatenate(docs), np.concatenate(held))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int64()), "n_ids": pa.array([waiting], pa.int64()), "chunk": pa.array([data], pa.binary())})

        for batch in batches:
            part = batch.column("__part")[0].as_py() if batch.num_rows else part
            keys, row = batch.column("__id"), 0
            for piece in pieces(utf8(batch.column("__text")), BYTES_AT_ONCE):
                ids, lengths = bpe.encode(piece)
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                records = np.empty(len(piece), DOCUMENT)
                own = keys.slice(row, len(piece))
                records["doc_id"], records["null"], records["n"] = own.fill_null(0).to_numpy(), own.is_null().to_numpy(zero_copy_only=False), lengths + 1
                row += len(piece)
                ends = np.cumsum(lengths + 1)
                at = 0
                while at < len(piece):
                    before = int(ends[at - 1]) if at else 0
                    end = min(int(np.searchsorted(ends, before + per_chunk - waiting)) + 1, len(piece))
                    docs.append(records[at:end])
                    held.append(ids[before : ends[end - 1]])
                    waiting += int(ends[end - 1]) - before
                    at = end
                    if waiting >= per_chunk:
                        yield chunk()
                        docs, held, waiting, seq = [], [], 0, seq + 1
        if docs:
            yield chunk()
    return run


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None, per_chunk: int = IDS_PER_CHUNK) -> None:
    """Encode the documents and write the chunks to `folder`, ranges of doc_id in ascending order.

    The texts are dealt to ranges by doc_id, then by a hash of the text and by the row's place in the input, so
    that even one id on a third of all rows is split.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"),
                        F.xxhash64(text_col).alias("__hash"), F.monotonically_increasing_id().alias("__row"))
    keys = [F.col(c).asc_nulls_first() for c in ("__id", "__hash", "__row")]
    dealt = keyed.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    chunks = dealt.select("__id", "__text", F.spark_partition_id().alias("__part"))
    chunks.mapInArrow(_chunks(path, end_id, per_chunk), "part int, seq long, n_ids long, chunk binary").write.parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each chunk: where they start in it, how many ids, and their checksum."""
    for batch in batches:
        rows = zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("chunk"), strict=True)
        for part, seq, data in rows:
            docs, ids = read_chunk(data.as_buffer().to_pybytes())
            n = docs["n"].astype(np.int64)
            ends = np.cumsum(n)
            view = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(n), part, np.int32)), "seq": pa.array(np.full(len(n), seq, np.int64)),
                "doc_id": pa.array(docs["doc_id"].astype(np.int64), mask=docs["null"] > 0),
                "at": pa.array(ends - n), "n_tokens": pa.array(n), "ids_crc32": pa.array(sums, pa.int64())})


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """(part, seq, before): the ids before every chunk. One row a partition meets in one task, no more."""
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return chunks.select("part", "seq", "n_ids").join(offsets, "part").select("part", "seq", before.alias("before"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files; the ids stay where they are read."""
    chunks = spark.read.schema("part int, seq long, n_ids long, chunk binary").parquet(folder)
    docs = chunks.select("part", "seq", "chunk").mapInArrow(
        _documents, "part int, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")
    start = (F.col("before") + F.col("at")).alias("start")
    return docs.join(chunk_starts(chunks), ["part", "seq"]).select("doc_id", start, "n_tokens", "ids_crc32")
