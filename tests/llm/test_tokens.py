"""Encoding, token files and edit-aware counts against the tiktoken library and plain versions."""

import hashlib
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm import bpe, edits, pfor
from riskspark.llm.text import utf8

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = [*"abc   \n\té'st1,.!\x85\x1c", "🙂", "中文", "don't ", "  ", "\n\n", "<|endoftext|>", "👨‍👩‍👧"]


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._rank_file(RANKS), special_tokens={})


def texts(n, longest=60, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("path", [RANKS, JSON])
def test_ids_are_those_of_the_library(path, plain):
    some, own = texts(3000), bpe.ByteBpe(path)
    ids, n = own.encode(utf8(pa.array(some)))
    split = np.split(ids, np.cumsum(n)[:-1])
    assert [x.tolist() for x in split] == [plain.encode_ordinary(t) for t in some]
    assert [own.decode(x).decode() for x in split] == some


def test_offsets_cover_split_characters_whole(plain):
    own, text = bpe.vocabulary(RANKS), "a🙂中b é"
    ids = np.array(plain.encode_ordinary(text))
    offsets = own.offsets(text, ids)
    assert offsets[0].tolist() == [0, 1] and offsets[-1][1] == len(text)
    for (a, b), i in zip(offsets.tolist(), ids.tolist(), strict=True):
        assert own.bytes_of[i] in text[a:b].encode()


def test_byte_table_has_a_character_for_each_byte():
    table = bpe.byte_characters()
    assert len(set(table)) == 256 and table[ord("A")] == "A" and table[32] == "Ġ"


def test_encode_and_decode_columns(spark, odd, none, plain):
    coded = bpe.encode_documents(odd, RANKS, ids_col="ids")
    rows = coded.select("text", "ids", bpe.decode(F.col("ids"), RANKS).alias("back"), "set").collect()
    assert len(rows) == odd.count() and all(r.set in ("b", None) for r in rows)
    for r in rows:
        assert list(r.ids) == plain.encode_ordinary(r.text or "") and bytes(r.back).decode() == (r.text or "")
    assert bpe.encode_documents(none, RANKS).collect() == []
    offsets = odd.select("text", bpe.encode(F.col("text"), JSON, with_offsets=True).alias("e")).collect()
    assert all(len(r.e.ids) == len(r.e.starts) == len(r.e.ends) for r in offsets)


def test_round_trip_digest(odd, plain):
    for r in odd.select("text", bpe.round_trip_digest(F.col("text"), RANKS).alias("d")).collect():
        ids = plain.encode_ordinary(r.text or "")
        assert r.d.n_tokens == len(ids) and r.d.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@pytest.mark.parametrize("ids", [[], [5], [7] * 300, list(range(1000)), [0, 2**32 - 1] * 200, [1] * 120 + [50000] * 8 + [3]])
def test_blocks_give_back_their_ids(ids):
    starts, blocks = pfor.pack(np.array(ids, np.uint32))
    assert pfor.unpack(starts, blocks, len(ids)).tolist() == ids
    assert len(starts) == -(-len(ids) // pfor.BLOCK) + 1 and starts[-1] == len(blocks)


def test_outliers_go_to_exceptions():
    starts, blocks = pfor.pack(np.array([3] * 120 + [50000] * 8, np.uint32))
    assert blocks[4] == 0 and blocks[5] == 8 and len(blocks) == 6 + 8 * 5


def test_a_block_can_be_read_alone():
    ids = np.arange(1000, dtype=np.uint32) * 37 % 50000
    starts, blocks = pfor.pack(ids)
    one = pfor.unpack(np.array([0, starts[4] - starts[3]], np.uint32), blocks[starts[3] : starts[4]], pfor.BLOCK)
    assert one.tolist() == ids[3 * pfor.BLOCK : 4 * pfor.BLOCK].tolist()


def test_files_give_back_every_document(spark, odd, none, tmp_path):
    folder = str(tmp_path / "tokens")
    pfor.write_tokens(odd, folder, JSON, end_id=2, partitions=3, per_chunk=50)
    got = pfor.read_documents(spark, folder).orderBy("start").collect()
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    want = sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd.collect()), key=lambda x: x[0])
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == [w[0] for w in want]
    at, sums = 0, {}
    for i, t in want:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        sums.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in sums[-1 if r.doc_id is None else r.doc_id]
        at += r.n_tokens
    assert spark.read.parquet(folder).count() > 3
    pfor.write_tokens(none, str(tmp_path / "empty"), JSON, end_id=2)
    assert pfor.read_documents(spark, str(tmp_path / "empty")).collect() == []


def test_edits_count_as_a_whole_new_encoding_does():
    rng, c = random.Random(4), edits.counter(RANKS, public_tokenizers.PATTERN)
    encoded = whole = 0
    for t in texts(400, 900, 5):
        d = edits.Document(c, t)
        before = d.encoded
        for _ in range(4):
            at = rng.randint(-2, len(d.text) + 3)
            d.edit(at, at + rng.choice([0, 1, 3, 200]), rng.choice(texts(20, 12, at)))
        assert d.leaves()[0] == [len(p) for p in c.split.findall(d.text)]
        assert d.tree.total() == len(c.encoding.encode_ordinary(d.text)) == sum(d.leaves()[1])
        encoded, whole = encoded + d.encoded - before, whole + 4 * len(d.text)
    assert encoded < whole / 3


def test_edit_columns(spark, odd, none, plain):
    todo = F.array(F.struct(F.lit(2).alias("at"), F.lit(4).alias("end"), F.lit(" new ").alias("text")), F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("text")))
    for r in odd.select("text", edits.counts(F.col("text"), todo, RANKS, public_tokenizers.PATTERN).alias("c")).collect():
        t = r.text or ""
        assert r.c.n_tokens == len(plain.encode_ordinary(t))
        assert r.c.n_tokens_after == len(plain.encode_ordinary(t[:2] + " new " + t[4:]))
    kept = odd.select("text", edits.leaves(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("l"))
    for r in kept.select("text", edits.edited(F.col("text"), F.col("l"), F.lit(None).cast(f"array<{edits.EDIT}>"), RANKS, public_tokenizers.PATTERN).alias("e")).collect():
        assert r.e.text == (r.text or "") and r.e.encoded == 0 and r.e.n_tokens == len(plain.encode_ordinary(r.e.text))
    assert none.select(edits.counts(F.col("text"), todo, RANKS, public_tokenizers.PATTERN).alias("c")).collect() == []


def test_an_encoding_worker_uses_one_core_and_small_pieces():
    """The library's threads and large pieces made workers of some 300 MB, two of them beside an executor."""
    code = """if True:
        import os, sys
        from riskspark.llm import bpe
        own = bpe.vocabulary(sys.argv[1])
        before = len(os.listdir("/proc/self/task"))
        own._whole([f" word{i} and more" for i in range(5000)])
        print(len(os.listdir("/proc/self/task")) - before)
    """
    root = Path(bpe.__file__).parents[2]
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    run = subprocess.run([sys.executable, "-c", code, RANKS], capture_output=True, text=True, cwd=root, env=env, check=True)
    assert int(run.stdout) == 0 and bpe.BYTES_AT_ONCE <= 1 << 20
