"""Helpers shared by the text operators: cutting Arrow columns into bounded pieces, hashing, reading tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.session import materialise

#: Bytes of text that one step of an operator works on; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids that no training may see; a NULL id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def bounded_sample(docs: DataFrame, groups: DataFrame, per_group: int, id_col: str = "doc_id", text_col: str = "text", most_bytes: int | None = None) -> DataFrame:
    """(group, id, text) of at most `per_group` ids of each group, those with the smallest hash.

    With `most_bytes` the groups' rows have `bytes`, the size of their text: a group's texts in the sample have that
    many bytes at most, texts of more than an eighth of it are left out of the sample, and none is cut.

    `groups` has rows of `id` and `group`. Ids are drawn first: a threshold on the hash, from the group's size,
    leaves about twice the ids wanted, of which each group's first are taken. Only their texts are then looked up,
    by a join whose one side has at most groups x per_group rows; the texts are not exchanged. Of a repeated id
    the least text counts.
    """
    rows = groups.filter("id is not null and group is not null")
    if most_bytes is None:
        rows = rows.select("id", "group").distinct()
    else:
        rows = rows.groupBy("id", "group").agg(F.max("bytes").alias("bytes")).filter(F.col("bytes") * 8 <= most_bytes)
    sizes = materialise(rows.groupBy("group").agg(F.count("*").alias("c")), "sample-sizes")
    draw = F.shiftrightunsigned(F.xxhash64("id", F.lit(9)), 11) / F.lit(float(1 << 53))
    likely = rows.withColumn("h", draw).join(sizes, "group").filter(F.col("h") * F.col("c") < 2 * per_group + 100)
    first = Window.partitionBy("group").orderBy("h", "id")
    chosen = likely.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_group)
    if most_bytes is not None:
        chosen = chosen.withColumn("b", F.sum("bytes").over(first.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("b") <= most_bytes)
    chosen = materialise(chosen.select("id", "group"), "sample-ids")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return texts.groupBy("group", "id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


#: Bits of a sieve, 16 MB in all, in rows of 4 KB: the bound of what is broadcast.
SIEVE_BITS = 1 << 27


def _sieve_place(key: Column) -> Column:
    """A place from 1 on."""
    return F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)) + 1


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes of keys, rows of (bucket, bits); its size is bounded whatever the number of keys."""
    place = _sieve_place(F.col(key))
    return materialise(keys.groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits")), "sieve")


def sifted(df: DataFrame, key: Column, held: DataFrame) -> DataFrame:
    """The rows of `df` with `__may`: false only if the key is none of those in the sieve, and so no join with them finds it.

    The sieve goes to all tasks and the rows stay where they are. The more keys it holds, the more rows may be in it.
    """
    place = _sieve_place(key)
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", F.coalesce(byte, F.lit(0)), F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(1) == 1
    found = df.withColumn("__at", F.bitmap_bucket_number(place)).join(F.broadcast(held), F.col("__at") == F.col("__bucket"), "left")
    return found.withColumn("__may", bit).drop("__at", "__bucket", "__bits")


def utf8(texts: pa.Array) -> pa.Array:
    """The texts as large strings, NULL as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large-string array, and where each text starts (one more entry for the end)."""
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None and len(starts) else np.empty(0, np.uint8)
    return flat, starts - starts[0]


def pieces(texts: pa.Array, most: int = PIECE_BYTES, rows: int = 1 << 14) -> Iterator[pa.Array]:
    """Consecutive runs of rows of about `most` bytes and at most `rows` rows; always at least one row."""
    if not len(texts):
        return
    _, starts = raw(texts)
    at = 0
    while at < len(texts):
        end = min(max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1), at + rows)
        yield texts.slice(at, end - at)
        at = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal numbers stay equal, near ones are spread."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTES = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in _BASES]


def span_hashes(flat: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes, one of two independent ones.

    A polynomial over the bytes from a running sum, moved back to the stretch's start.
    """
    if not len(begin):
        return np.empty(0, np.uint64)
    base = _BASES[which]
    power, back = np.full(len(flat) + 1, base, np.uint64), np.full(len(flat) + 1, pow(base, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    # In place: each of these arrays has eight times the size of the text.
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    run = np.zeros(len(flat) + 1, np.uint64)
    np.multiply(_BYTES[which][flat], power[:-1], out=run[1:])
    np.cumsum(run, out=run)
    return mixed((run[end] - run[begin]) * back[begin] + (end - begin).astype(np.uint64))


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these lengths laid end to end: each element's group, and its place within the group."""
    group = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return group, np.arange(len(group)) - first[group] if len(group) else np.empty(0, np.int64)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Lists of these lengths over consecutive values."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
