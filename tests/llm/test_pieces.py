"""SentencePiece encoding by prefix tables against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from riskspark.llm import piecebpe
from riskspark.llm.text import utf8

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"abcehinorst   \n\té'1,.!\x85\x1c▁\x00", "🙂", "中文", "don't ", "  ", "\n\n", "<s>", "<0x41>", "the", "ing", "tion", " " * 17, " " * 33, "aaaa", "ñ", "﷽"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return piecebpe.PieceBpe(MODEL)


def test_ids_are_those_of_the_library(own, library):
    rng = random.Random(1)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 80))) for _ in range(4000)] + ["", " ", "a" * 5000, " " * 1000, "x" * 100 + " " + "中" * 300]
    for batch in (some, some[:1], [""], []):
        ids, n = own.encode(utf8(pa.array(batch, pa.string())))
        assert len(n) == len(batch) and n.sum() == len(ids)
        split = np.split(ids, np.cumsum(n)[:-1]) if len(n) else []
        assert [x.tolist() for x in split] == [library.encode(t) for t in batch]


def test_pair_test_is_what_merging_the_pair_gives(own):
    rng, known = random.Random(2), sorted(own.id_of)
    spaces = [p for p in known if set(p) == {"▁"}]
    for _ in range(6000):
        a, b = rng.choice(known), rng.choice(spaces if rng.random() < 0.3 else known)
        assert own.compatible(a, b) == (own.merged(a + b) == [a, b])


def test_prefix_table_holds_the_last_piece_of_every_prefix(own):
    for word in ("▁internationalisation", "▁▁▁▁▁", "▁mañana中x", "aaaaaaa"):
        last = own.prefix_table(word)
        assert [last[k] or word[k - 1] for k in range(1, len(word) + 1)] == [own.merged(word[:k])[-1] for k in range(1, len(word) + 1)]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(piecebpe, "WORDS_KEPT", 5)
    monkeypatch.setattr(piecebpe, "PAIRS_KEPT", 5)
    own = piecebpe.PieceBpe(MODEL)
    for text in ("some words here and there", "other words, and there again", "some words"):
        assert own.encode(utf8(pa.array([text])))[0].tolist() == library.encode(text)


def test_columns(spark, odd, none, library):
    coded = piecebpe.encode_documents(odd, MODEL, ids_col="ids")
    rows = coded.select("text", "ids", piecebpe.decode(F.col("ids"), MODEL).alias("back"), "set").collect()
    assert len(rows) == odd.count() and all(r.set in ("b", None) for r in rows)
    for r in rows:
        assert list(r.ids) == library.encode(r.text or "") and r.back == library.decode(library.encode(r.text or ""))
    digests = odd.select("text", piecebpe.round_trip_digest(F.col("text"), MODEL).alias("d")).select("text", "d.*").collect()
    for r in digests:
        ids = library.encode(r.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piecebpe.encode_documents(none, MODEL).collect() == []


def test_the_query_equals_the_library(spark, library):
    from riskspark.llm.queries import QUERIES
    from riskspark.llm.text import table
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids_sha256 for r in QUERIES["op12_sentencepiece_prefix_table"](spark, folder).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, library.encode(t or ""))).encode()).hexdigest() for k, t in texts.items()}
