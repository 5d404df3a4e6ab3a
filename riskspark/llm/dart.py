"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is the weighted set of its shingles: five consecutive words, lower-cased; fewer words are one shingle.
Every shingle owns a region as high as its weight, cut into layers of height one. Hashes throw darts into each
layer: a Poisson process gives their ranks (one on average for each unit of rank), further hashes their heights
and one of COORDINATES coordinates. A dart counts if it is below the shingle's weight. Each coordinate keeps its
earliest dart. Only darts up to a rank that leaves few coordinates open are thrown - for a long document most
shingles have none - and the rank is doubled for documents with open coordinates, which changes no coordinate
already decided. Two documents agree in a coordinate with the probability of their weighted Jaccard similarity.

BANDS bands of ROWS coordinates make the buckets. Documents with equal shingle sets share one representative
first. In a bucket of at most SMALL representatives all are compared. For larger ones each bucket has a centre:
the member whose buckets are largest in sum, or the centre of that member's own largest bucket, and so on. All
members are compared with their buckets' centres. What is still in several classes after that is compared
through what it has beyond its centre's set, its extra shingles: two sets that are alike either share extras -
as many as their sizes and their overlap with the centre leave to be shared - or are both nearly within the
centre. The first are found by a prefix join (rarest extras first, as many as at least one shared one must be
among), the second by size. So every pair of a bucket that is in two classes and can be alike at all is compared,
and edits of one document alone cost no pairs, however many documents lie around one centre.
Pairs are compared exactly, by their shingle sets. At a similarity of 0.8 a pair shares no bucket with a
probability of 2e-5, less above.

Classes are the connected components of the links, named by the least id of their rows; without one, NULL. They
are classes of texts: rows with one id and different texts may lie in different classes, rows without an id lie
in their text's. NULL and empty texts (no words) are each alone. Empty tables give empty results. Further columns
are ignored by `near_duplicates` and kept by `distinct_documents`, where working columns start with `__near`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.text import list_array, mixed, pieces, ragged, raw, sieve, sifted, utf8
from riskspark.operators.keyed import first_per_key
from riskspark.session import discard, materialise

WORDS = 5
ALIKE = 0.8
BANDS, ROWS = 28, 5
#: Darts thrown at first, for each coordinate.
DARTS = 7.0
SMALL = 8
#: Sizes of sets that one step of the search by size joins: a step is so much larger than the one before.
SIZE_STEP = 1.02
#: Words of 64 bits in a bitmap of a document's extra shingles.
BIT_WORDS = 8
#: Text and rows that a worker sketches at once: a row throws some thousand darts.
BYTES_AT_ONCE, ROWS_AT_ONCE = 1 << 20, 512
#: Bytes, or words, of a long text that one step works on.
WINDOW = 1 << 18
SHINGLE_BITS = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_PLACE = mixed(np.arange(1, 1 + WORDS, dtype=np.uint64)) | np.uint64(1)


def word_hashes(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (run of non-space bytes) of texts laid end to end, and words per text.

    Bytes are worked through in windows; a word over a window's end is put together from its parts.
    """
    if not len(flat):
        return np.empty(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    # A polynomial over the bytes from a running sum, moved back to the part's start.
    size = min(WINDOW, len(flat))
    power, back = np.full(size + 1, _BASE), np.full(size + 1, _BASE_INVERSE)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums, lengths, begins = [], [], []
    for at in range(0, len(flat), size):
        part = flat[at : at + size]
        solid = ~((part == 32) | ((part >= 9) & (part <= 13)))
        fresh = np.zeros(len(part) + 1, bool)
        own = starts[np.searchsorted(starts, at) : np.searchsorted(starts, at + len(part), side="right")]
        fresh[own - at] = True
        before = np.concatenate([[False], solid[:-1]]) & ~fresh[:-1]
        after = np.concatenate([solid[1:], [False]]) & ~fresh[1:]
        begin, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * power[: len(part)])])
        h, n = (run[end] - run[begin]) * back[begin], end - begin
        if len(begin) and not begin[0] and not fresh[0] and begins and len(begins[-1]) and begins[-1][-1] + lengths[-1][-1] == at:
            sums[-1][-1:] += h[:1] * np.uint64(pow(int(_BASE), int(lengths[-1][-1]), 1 << 64))
            lengths[-1][-1] += n[0]
            h, n, begin = h[1:], n[1:], begin[1:]
        # A window inside one word adds no part of its own.
        if len(begin):
            sums.append(h)
            lengths.append(n)
            begins.append(begin + at)
    if not begins:
        return np.empty(0, np.uint64), np.zeros(len(starts) - 1, np.int64)
    h, n, begin = np.concatenate(sums), np.concatenate(lengths), np.concatenate(begins)
    return mixed(h + n.astype(np.uint64)), np.diff(np.searchsorted(begin, starts))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's different shingles in ascending order, end to end; how often each occurs; how many a text has."""
    flat, starts = raw(pc.utf8_lower(texts))
    word, n = word_hashes(flat, starts)
    hashes, times, per_text = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], np.zeros(len(texts), np.int64)
    ends = np.cumsum(n)
    last = 0
    while last < len(texts):
        # Runs of texts of about a window's words; a longer text is a run of its own.
        first, begun = last, ends[last] - n[last]
        last = max(first + 1, int(np.searchsorted(ends, begun + WINDOW, side="right")))
        own = n[first:last]
        key, count, per_text[first:last] = _run_shingles(word[begun : ends[last - 1]], own)
        hashes.append(key)
        times.append(count)
    return np.concatenate(hashes), np.concatenate(times), per_text


def _run_shingles(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(n) == 1:
        # One text, perhaps a long one: its shingles by slices, in place.
        count = np.array([max(len(word) - WORDS + 1, min(len(word), 1))])
        h = np.zeros(count[0], np.uint64)
        for k in range(WORDS):
            own = word[k : k + len(h)]
            h[: len(own)] += own * _PLACE[k]
            h[len(own) :] += np.uint64(k + 1) * _PLACE[k : k + 1]
        keys = np.sort(mixed(h) >> np.uint64(64 - SHINGLE_BITS))
    else:
        count = np.where(n > 0, np.maximum(n - WORDS + 1, 1), 0)
        text, place = ragged(count)
        at = (np.cumsum(n) - n)[text] + place
        h = np.zeros(len(at), np.uint64)
        padded = np.concatenate([word, np.zeros(WORDS, np.uint64)])
        for k in range(WORDS):
            inside = place + k < n[text]
            h += np.where(inside, padded[at + k], np.uint64(k + 1)) * _PLACE[k]
        keys = np.sort((text.astype(np.uint64) << np.uint64(SHINGLE_BITS)) | (mixed(h) >> np.uint64(64 - SHINGLE_BITS)))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    times = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    per_text = np.bincount((keys >> np.uint64(SHINGLE_BITS)).astype(np.int64), minlength=len(n))
    return keys & np.uint64((1 << SHINGLE_BITS) - 1), times, per_text


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((mixed(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(h: np.ndarray, weight: np.ndarray, n: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of each coordinate, texts by coordinates; all zero for a text without shingles."""
    out = np.zeros((len(n), coordinates), np.uint64)
    text = np.repeat(np.arange(len(n)), n)
    total = np.bincount(text, weight, minlength=len(n))
    limit = DARTS * coordinates / np.maximum(total, 1e-300)
    todo = np.flatnonzero(n)
    while len(todo):
        local = np.full(len(n), -1)
        local[todo] = np.arange(len(todo))
        own = local[text] >= 0
        rank, dart = _earliest(h[own], weight[own], local[text[own]], limit[todo], len(todo), coordinates)
        done = np.isfinite(rank).all(axis=1)
        out[todo[done]] = dart[done]
        todo = todo[~done]
        limit[todo] *= 2
    return out


def _earliest(h: np.ndarray, weight: np.ndarray, text: np.ndarray, limit: np.ndarray, n: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rank_of, dart_of = np.full(n * coordinates, np.inf), np.full(n * coordinates, np.iinfo(np.uint64).max)
    for layer in range(int(np.ceil(weight.max(initial=0)))):
        on = weight > layer
        seed = mixed(h[on] + np.uint64((layer + 1) * int(_BASE) % (1 << 64)))
        room, where = weight[on] - layer, text[on]
        rank, i = np.zeros(len(seed)), 0
        while len(seed):
            i += 1
            dart = mixed(seed + np.uint64(i * 0xBF58476D1CE4E5B9 % (1 << 64)))
            rank = rank - np.log(_uniform(dart + np.uint64(1)))
            early = rank < limit[where]
            seed, rank, where, room, dart = seed[early], rank[early], where[early], room[early], dart[early]
            hit = _uniform(dart + np.uint64(2)) < room if len(room) and room.min() < 1 else slice(None)
            slot = where[hit] * coordinates + (mixed(dart[hit] + np.uint64(3)) % np.uint64(coordinates)).astype(np.int64)
            better = rank[hit] < rank_of[slot]
            slot, r, d = slot[better], rank[hit][better], dart[hit][better]
            np.minimum.at(rank_of, slot, r)
            first = r == rank_of[slot]
            dart_of[slot[first]] = d[first]
    return rank_of.reshape(n, coordinates), dart_of.reshape(n, coordinates)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Of each band, a hash of its coordinates and number."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = mixed(key * _BASE + parts[:, :, k])
    return key.view(np.int64) if key.flags["C_CONTIGUOUS"] else np.ascontiguousarray(key).view(np.int64)


def sketch(text: Column, by_count: bool = False) -> Column:
    """Struct of n (the set's size), a and b (a fingerprint of the set), and bands array<long>.

    `by_count` weighs a shingle by its occurrences, else by presence.
    """
    @F.arrow_udf("struct<n: int, a: bigint, b: bigint, bands: array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in pieces(utf8(batch), BYTES_AT_ONCE, ROWS_AT_ONCE) if len(batch) else [utf8(batch)]:
                yield _sketched(part, by_count)
            pa.default_memory_pool().release_unused()
    return run(text)


def _sketched(texts: pa.Array, by_count: bool) -> pa.Array:
    h, times, n = shingles(texts)
    bands = band_keys(signatures(h, times.astype(float) if by_count else np.ones(len(h)), n))
    if by_count:
        h, n = _repeated(h, times, n)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h + np.uint64(s)))]) for s in (11, 12)]
    ends = np.cumsum(n)
    a, b = ((s[ends] - s[ends - n]).view(np.int64) for s in sums)
    lists = list_array(pa.array(bands.reshape(-1), pa.int64()), np.full(len(n), BANDS))
    return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(a), pa.array(b), lists], ["n", "a", "b", "bands"])


def _repeated(h: np.ndarray, times: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set with an element for each occurrence: the similarity of such sets is the one weighted by occurrences."""
    which, number = ragged(times)
    out = mixed(h[which] + number.astype(np.uint64) * _BASE) >> np.uint64(64 - SHINGLE_BITS)
    ends = np.concatenate([[0], np.cumsum(times)])
    bounds = np.concatenate([[0], np.cumsum(n)])
    return out, np.diff(ends[bounds])


def shingle_set(text: Column, by_count: bool = False) -> Column:
    """array<long> of a text's set of shingles."""
    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in pieces(utf8(batch), BYTES_AT_ONCE, ROWS_AT_ONCE) if len(batch) else [utf8(batch)]:
                h, times, n = shingles(part)
                if by_count:
                    h, n = _repeated(h, times, n)
                yield list_array(pa.array(h.astype(np.int64)), n)
    return run(text)


def components(edges: DataFrame) -> DataFrame:
    """(id, class) for the ends of edges (a, b): the least id of each connected component.

    Each round every id takes the least class among its own and its neighbours', then its class's class. Each
    round is written; only the number of changes reaches the driver.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    now = last = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("class")), "classes")
    while True:
        near = both.join(now.select(F.col("id").alias("b"), F.col("class").alias("c")), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        step = now.join(near, "id").select("id", F.col("class").alias("old"), F.least("class", "c").alias("class"))
        step = materialise(step, "classes")
        jump = step.select(F.col("id").alias("class"), F.col("class").alias("up"))
        jumped = materialise(step.join(jump, "class").select("id", "old", F.least("class", "up").alias("class")), "classes")
        changed = jumped.filter(F.col("class") < F.col("old")).count()
        discard(step, last)
        now, last = jumped.select("id", "class"), jumped
        if not changed:
            discard(both)
            return now


def _needed(n: Column, n2: Column, alike: float) -> Column:
    """The least overlap of two alike sets of these sizes, to be met by a whole number."""
    return F.lit(alike / (1 + alike)) * (n + n2) - 1e-9


def _compared(pairs: DataFrame, sets: DataFrame, alike: float) -> DataFrame:
    """Pairs (a, b) whose sets are alike."""
    x = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    x = x.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return x.filter(common >= _needed(F.size("sa"), F.size("sb"), alike)).select("a", "b")


def _close(n: Column, n2: Column, alike: float) -> Column:
    """Whether the sizes of two sets leave the similarity open."""
    return F.least(n, n2) >= F.lit(alike) * F.greatest(n, n2) - 1e-9


def _small_pairs(members: DataFrame, alike: float) -> DataFrame:
    """All pairs (a, b) of the buckets (key, id, n, m) of at most SMALL."""
    few = members.filter(F.col("m") <= SMALL)
    x, y = (few.select("key", F.col("id").alias(i), F.col("n").alias(f"n_{i}")) for i in "ab")
    close = (F.col("a") < F.col("b")) & _close(F.col("n_a"), F.col("n_b"), alike)
    return x.join(y, "key").filter(close).select("a", "b").distinct()


def _centres(large: DataFrame) -> DataFrame:
    """(key, centre) for the members (key, id, n, m) of large buckets.

    A member's weight is the sum of its buckets' sizes: the text that most others are edits of is in the largest.
    A bucket's heaviest member hands on to the heaviest member of its own buckets, up to one that is that itself.
    """
    weight = large.groupBy("id").agg(F.sum("m").alias("w"))
    weighed = materialise(large.join(materialise(weight, "dart-weights"), "id").select("key", "id", "w"), "dart-weighed")
    heaviest = weighed.groupBy("key").agg(F.max(F.struct("w", "id")).alias("top"))
    heaviest = materialise(heaviest, "dart-heaviest")
    up = weighed.join(heaviest, "key").groupBy("id").agg(F.max("top").alias("top"))
    now = materialise(up.select("id", F.col("top.id").alias("up")), "dart-centres")
    discard(weighed)
    while True:
        above = now.select(F.col("id").alias("up"), F.col("up").alias("top"))
        step = materialise(now.join(above, "up").select("id", "up", "top"), "dart-centres")
        done = step.filter("up <> top").isEmpty()
        now = step.select("id", F.col("top").alias("up"))
        if done:
            return heaviest.select("key", F.col("top.id").alias("id")).join(now, "id").select("key", F.col("up").alias("centre"))


def _around(sets: DataFrame) -> DataFrame:
    """(id, n, centre, centre_n, common, extra) of the sets (id, set, centres) and each of their buckets' centres.

    `common` is the size of the overlap, `extra` the member's shingles that the centre doesn't have.
    """
    own = sets.select("id", "set", F.explode("centres").alias("centre")).filter("id <> centre")
    centre = sets.filter(F.array_contains("centres", F.col("id"))).select(F.col("id").alias("centre"), F.col("set").alias("centre_set"))
    x = own.join(centre, "centre")
    extra = F.array_except("set", "centre_set")
    out = x.select("id", F.size("set").alias("n"), "centre", F.size("centre_set").alias("centre_n"), (F.size("set") - F.size(extra)).alias("common"), extra.alias("extra"))
    return materialise(out, "dart-around")


def _bitmap(extra: Column) -> Column:
    """array<long>: a bit for each extra shingle's hash."""
    def word(w: Column) -> Column:
        own = F.filter(extra, lambda s: F.pmod(F.floor(s / 64), F.lit(BIT_WORDS)) == w)
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, s: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(s, F.lit(64)).cast("int"))))
    return F.transform(F.sequence(F.lit(0), F.lit(BIT_WORDS - 1)), word)


def _set_bits(bits: Callable[[int], Column]) -> Column:
    total = F.bit_count(bits(0))
    for w in range(1, BIT_WORDS):
        total = total + F.bit_count(bits(w))
    return total


def _open_pairs(around: DataFrame, classes: DataFrame, alike: float) -> DataFrame:
    """Pairs (a, b) around one centre that are in different classes (id, class) and may be alike.

    For sets with overlaps c and c2 with the centre, the extras they share are all they have in common beyond
    min(c, c2); the least overlap that makes them alike, less that, is how many extras they share at least.
    """
    of = classes.select("id", "class")
    known = around.join(of, "id", "left").withColumn("class", F.coalesce("class", "id"))
    known = known.select("id", "n", "centre", "common", F.size("extra").alias("e"), "class")
    known = materialise(known, "dart-known")
    centre_class = known.select("centre").distinct().join(of.withColumnRenamed("id", "centre"), "centre", "left").select("centre", F.coalesce("class", "centre").alias("centre_class"))
    several = known.groupBy("centre").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).join(centre_class, "centre")
    several = materialise(several.filter("lo <> hi").select("centre", "centre_class"), "dart-several")
    rows = materialise(known.join(several, "centre"), "dart-open")

    # Any partner has at least `alike` times the size, so this many extras are shared at least.
    least = F.greatest(F.lit(1), F.ceil(F.lit(alike) * F.col("n") - 1e-9).cast("int") - F.col("common"))
    asking = rows.withColumn("prefix", F.col("e") - least + 1).filter("prefix >= 1")
    asking = around.select("id", "centre", "extra").join(asking, ["id", "centre"])
    asking = materialise(asking.withColumn("bits", _bitmap(F.col("extra"))), "dart-asking")
    extras = asking.withColumn("s", F.explode("extra")).drop("extra", "bits")
    often = extras.groupBy("centre", "s").agg(F.count("*").alias("f"), (F.min("class") < F.max("class")).alias("mixed")).filter("f > 1")
    shared = extras.join(materialise(often, "dart-shared"), ["centre", "s"])
    # Extras of one document alone come first in the order; then the rarer, ties by the shingle.
    order = F.sort_array(F.collect_list(F.struct("f", "s", "mixed")))
    heads = shared.groupBy("id", "n", "centre", "common", "e", "class", "prefix").agg(order.alias("all"))
    left = F.col("prefix") - (F.col("e") - F.size("all"))
    heads = heads.filter(left > 0).withColumn("x", F.explode(F.slice("all", F.lit(1), left))).filter("x.mixed")
    heads = heads.select("id", "n", "centre", "common", "e", "class", F.col("x.s").alias("s"))
    heads = materialise(heads.join(asking.select("id", "centre", "bits"), ["id", "centre"]), "dart-heads")

    def joined(x: DataFrame, y: DataFrame, on: list[str], also: Column) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        same = also & (F.col("x.class") != F.col("y.class")) & _close(F.col("x.n"), F.col("y.n"), alike)
        for c in on:
            same &= F.col(f"x.{c}") == F.col(f"y.{c}")
        return x.join(y, same).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    both = lambda c: F.least(f"x.{c}", f"y.{c}")
    needed = _needed(F.col("x.n"), F.col("y.n"), alike)
    # Of the extras shared each sets a bit that both have, but for those of one document that share a bit.
    met = _set_bits(lambda w: F.get("x.bits", F.lit(w)).bitwiseAND(F.get("y.bits", F.lit(w))))
    lost = F.least(*[F.col(f"{d}.e") - _set_bits(lambda w, d=d: F.get(f"{d}.bits", F.lit(w))) for d in "xy"])
    by_extra = joined(heads, heads, ["centre", "s"], (F.col("x.id") < F.col("y.id")) & (both("common") + F.least(both("e"), met + lost) >= needed))

    # Nearly within the centre both: at most this size is left for the partner of one outside the centre's class.
    step = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(SIZE_STEP)) + 1e-9).cast("int")
    near = rows.filter(F.col("common") >= F.lit(alike) * F.col("n") - 1e-9)
    most = F.col("common") * ((1 + alike) / alike) - F.col("n") + 1e-6
    steps = F.explode(F.sequence(step(F.greatest(F.lit(1.0), F.lit(alike) * F.col("n") - 1e-6)), step(most)))
    outside = near.filter((F.col("class") != F.col("centre_class")) & (most >= F.greatest(F.lit(1.0), F.lit(alike) * F.col("n") - 1e-6)))
    by_size = joined(outside.withColumn("size", steps), near.withColumn("size", step(F.col("n"))), ["centre", "size"], both("common") >= needed)
    return materialise(by_extra.unionByName(by_size).distinct(), "dart-open-pairs")


def _classified(docs: DataFrame, id_col: str, text_col: str, alike: float, by_count: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, place, n, a, b), one for each document row, and (a, b, n, class) of the different sets.

    `place` is a hash of the text, by which texts are looked up again.
    """
    text, place = F.col(text_col), F.xxhash64(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), place.alias("place"), sketch(text, by_count).alias("s"))
    rows = materialise(rows.select("doc_id", "place", "s.*"), "dart-sketches")
    same = rows.filter("n > 0").groupBy("a", "b", "n").agg(F.min(F.struct("place", "doc_id")).alias("of"), F.first("bands").alias("bands"))
    same = materialise(same.select(F.monotonically_increasing_id().alias("id"), "a", "b", "n", "of", "bands"), "dart-sets")
    spread = same.select("id", "n", F.explode("bands").alias("key"))
    # Buckets of one are most; the members of the others are written. The sieve keeps most of the rest from the join.
    shared = materialise(spread.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "dart-buckets")
    likely = sifted(spread, F.col("key"), sieve(shared, "key")).filter("__may").drop("__may")
    members = materialise(likely.join(shared, "key"), "dart-members")
    large = members.filter(F.col("m") > SMALL)
    centres = large.join(materialise(_centres(large), "dart-key-centres"), "key").groupBy("id").agg(F.collect_set("centre").alias("centres"))
    ids = members.select("id").distinct().join(centres, "id", "left")
    wanted = same.select("id", "of").join(materialise(ids, "dart-ids"), "id")
    wanted = materialise(wanted.select("id", F.col("of.place").alias("place"), F.col("of.doc_id").alias("of"), F.coalesce("centres", F.array().cast("array<bigint>")).alias("centres")), "dart-wanted")
    held = sieve(wanted, "place")
    # Rows equal in id and text to the one wanted: they are looked up once.
    again = sifted(rows.select("doc_id", "place"), F.col("place"), held).filter("__may")
    again = again.join(wanted, (again["place"] == wanted["place"]) & again["doc_id"].eqNullSafe(wanted["of"])).groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1")
    again = materialise(again, "dart-again")
    wanted = materialise(wanted.join(again, "id", "left"), "dart-wanted")
    found = sifted(docs.select(F.col(id_col).cast("long").alias("doc_id"), place.alias("place"), text.alias("text")), F.col("place"), held).filter("__may")
    found = found.join(wanted, (found["place"] == wanted["place"]) & found["doc_id"].eqNullSafe(wanted["of"])).select("id", "centres", "rows", "text")
    once = found.filter("rows is null")
    if not again.isEmpty():
        once = once.unionByName(found.filter("rows > 1").dropDuplicates(["id"]))
    sets = materialise(once.select("id", "centres", shingle_set(F.col("text"), by_count).alias("set")), "dart-shingles")

    around = _around(sets)
    links = _compared(materialise(_small_pairs(members, alike), "dart-pairs"), sets, alike)
    star = around.filter(F.col("common") >= _needed(F.col("n"), F.col("centre_n"), alike)).select(F.col("id").alias("a"), F.col("centre").alias("b"))
    links = materialise(links.unionByName(star), "dart-links")
    discard(members)
    classes = materialise(components(links), "dart-classes")
    pairs = _open_pairs(around, classes, alike)
    if not pairs.isEmpty():
        classes = materialise(components(links.unionByName(_compared(pairs, sets, alike))), "dart-classes")
    discard(sets, around)
    per_set = same.select("id", "a", "b", "n").join(classes, "id", "left").select("a", "b", "n", F.coalesce("class", "id").alias("class"))
    return rows, materialise(per_set, "dart-set-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: float = ALIKE, by_count: bool = False) -> DataFrame:
    """One row per document row: `doc_id` and `class_id`, the least id of its class."""
    rows, per_set = _classified(docs, id_col, text_col, alike, by_count)
    found = rows.filter("n > 0").select("doc_id", "a", "b", "n").join(per_set, ["a", "b", "n"]).select("doc_id", "class")
    found = materialise(found, "dart-rows")
    names = materialise(found.groupBy("class").agg(F.min("doc_id").alias("class_id")), "dart-names")
    alone = rows.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"))
    return found.join(names, "class").select("doc_id", "class_id").unionByName(alone)


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: float = ALIKE, by_count: bool = False) -> DataFrame:
    """The documents, one row of each class: that with the least id (rows without one last; ties: by the text's hash).

    Of rows that are equal in id and text any one stays, with its further columns. Texts without words stay all.
    """
    rows, per_set = _classified(docs, id_col, text_col, alike, by_count)
    rows = materialise(rows.filter("n > 0").select("doc_id", "place", "a", "b", "n").join(per_set, ["a", "b", "n"]).select("doc_id", "place", F.col("class").alias("__near_class")), "dart-rows")
    first = rows.groupBy("__near_class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "place")).alias("x"), F.count("*").alias("c"))
    # A text alone in its class stays without a join; the sieve tells most of these.
    crowded = first.filter("c > 1").select("__near_class", F.col("x.doc_id").alias("__near_id"), F.col("x.place").alias("__near_place"))
    crowded = materialise(crowded, "dart-first")
    places = rows.join(crowded.select("__near_class"), "__near_class").select("place")
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = sifted(docs.withColumn("__near_of", F.xxhash64(F.col(text_col))), F.col("__near_of"), sieve(places, "place"))
    clear = marked.filter(~(words & F.col("__may"))).select(*docs.columns)

    # Of the others, those alone in their class after all, and each class's first row.
    lone = first.filter("c = 1").select("__near_class", F.col("x.doc_id").alias("__near_id"), F.col("x.place").alias("__near_place"))
    lone = sifted(lone, F.col("__near_place"), sieve(places, "place")).filter("__may").drop("__may")
    chosen = materialise(crowded.unionByName(lone), "dart-chosen")
    again = rows.groupBy("doc_id", "place").agg(F.count("*").alias("c")).filter("c > 1")
    again = again.join(crowded, again["doc_id"].eqNullSafe(crowded["__near_id"]) & (again["place"] == crowded["__near_place"]))
    again = materialise(again.select("__near_class", F.lit(True).alias("__near_again")).distinct(), "dart-again")
    chosen = materialise(chosen.join(again, "__near_class", "left"), "dart-chosen")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__near_id")) & (F.col("__near_of") == F.col("__near_place"))
    kept = marked.filter(words & F.col("__may")).join(chosen, same)
    once = kept.filter("__near_again is null").select(*docs.columns)
    if not again.isEmpty():
        once = once.unionByName(kept.filter("__near_again").dropDuplicates(["__near_class"]).select(*docs.columns))
    return clear.unionByName(once)
