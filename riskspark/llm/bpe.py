"""Byte-level BPE with the tokenizers library over Arrow batches: ids, character offsets, and decoding.

A byte-level vocabulary writes each byte of UTF-8 as one printable character; `byte_characters` is that table.
Texts are encoded by their distinct words: a cut before a single space that a non-space character follows never
lies inside a pre-token, so the ids of a text are those of its words, each with its leading space, end to end.
Each distinct word of a batch goes through the library once, and a worker keeps the ids of words it has met. A text where a space stands before other white
space, or at the end, goes through it whole. No text is cut short.

NULL texts count as empty and give no ids. Ties and repeated rows need no rule: every row is encoded alone.
Other columns pass through untouched, whatever they are called.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from riskspark.llm.text import list_array, pieces, ragged, raw, span_hashes, utf8

#: A space that a word can't be cut at: white space follows, or nothing.
ODD_SPACE = r" (?:[\s\x0b\x{85}\p{Z}]|\z)"
WORDS_AT_ONCE = 128
#: Words whose ids a worker keeps, some 300 bytes each.
WORDS_KEPT = 200_000
#: More text at once has fewer distinct words for its size, and needs more memory.
BYTES_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 2048
TEXTS_AT_ONCE = 64


@functools.cache
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next unused one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def _rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge gives the token: what merging by lower ranks leaves of its bytes."""
    limit, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], limit))
        if ranks.get(parts[best] + parts[best + 1], limit) >= limit:
            return None
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteBpe:
    """One vocabulary: a `.json` of the tokenizers library, or a `.tiktoken` rank file."""

    def __init__(self, path: str):
        chars = byte_characters()
        if path.endswith(".json"):
            self.tokenizer = Tokenizer.from_file(path)
            with open(path, encoding="utf8") as f:
                vocab = json.load(f)["model"]["vocab"]
        else:
            ranks = _rank_file(path)
            text = {token: "".join(chars[b] for b in token) for token in ranks}
            vocab = {text[token]: rank for token, rank in ranks.items()}
            pairs = [_halves(token, ranks) for token in sorted(ranks, key=ranks.get) if len(token) > 1]
            merges = [(text[a], text[b]) for a, b in filter(None, pairs)]
            self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
            self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.tokenizer.encode_special_tokens = True
        of_char = {c: b for b, c in enumerate(chars)}
        size = max(vocab.values()) + 1
        self.bytes_of = [b""] * size
        for token, rank in vocab.items():
            self.bytes_of[rank] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
        self._forget()
        #: By id: does the token begin with a space, and so a word?
        self.starts_word = np.array([t[:1] == b" " for t in self.bytes_of])

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; few go through the library at a time, as its results are large."""
        parts = (self.tokenizer.encode_batch_fast(texts[a : a + TEXTS_AT_ONCE], add_special_tokens=False) for a in range(0, len(texts), TEXTS_AT_ONCE))
        return [np.array(e.ids, np.int32) for part in parts for e in part]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word after a space, end to end, and how many each has."""
        n = len(words)
        sizes = np.diff(np.append(np.arange(0, n, WORDS_AT_ONCE), n))
        joined = pc.binary_join(list_array(words.cast(pa.string()), sizes), " ").to_pylist()
        ids = np.concatenate([np.empty(0, np.int32), *self._whole([" " + x for x in joined])])
        return ids, np.bincount(np.cumsum(self.starts_word[ids]) - 1, minlength=n)

    def _forget(self) -> None:
        self.places: dict[int, int] = {}
        self.checks, self.begins, self.lengths = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool each word's ids begin, and how many it has. New words are encoded and kept.

        A word is known by two independent 64-bit hashes. At WORDS_KEPT words all are forgotten.
        """
        if len(self.places) > WORDS_KEPT:
            self._forget()
        flat, starts = raw(words)
        first, second = (span_hashes(flat, starts[:-1], starts[1:], which) for which in (0, 1))
        place = np.fromiter(map(self.places.get, first.tolist(), repeat(-1)), np.int64, len(words))
        known = place >= 0
        known[known] = self.checks[place[known]] == second[known]
        new = np.flatnonzero(~known)
        if len(new):
            ids, lengths = self._words(words.take(pa.array(new)))
            place[new] = np.arange(len(new)) + len(self.begins)
            self.begins = np.concatenate([self.begins, np.cumsum(lengths) - lengths + len(self.pool)])
            self.lengths, self.pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, ids])
            self.checks = np.concatenate([self.checks, second[new]])
            self.places.update(zip(first[new].tolist(), place[new].tolist(), strict=True))
        return self.begins[place], self.lengths[place]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (large strings, no NULL) end to end, and how many each has."""
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        if odd.any():
            for i, ids in zip(np.flatnonzero(odd), self._whole(texts.filter(pa.array(odd)).to_pylist()), strict=True):
                out[i] = ids
        plain = np.flatnonzero(~odd)
        if len(plain):
            split = pc.split_pattern(texts.take(pa.array(plain)), " ")
            bounds = np.asarray(split.offsets)
            words = split.values.slice(bounds[0], bounds[-1] - bounds[0])
            bounds = bounds - bounds[0]
            first = np.zeros(len(words), bool)
            first[bounds[:-1]] = True
            heads = self._whole(words.filter(pa.array(first)).to_pylist())
            coded = words.filter(pa.array(~first)).dictionary_encode()
            begins, lengths = self._known(coded.dictionary)
            codes = coded.indices.to_numpy()
            word, place = ragged(lengths[codes])
            tail = self.pool[begins[codes][word] + place] if len(word) else np.empty(0, np.int32)
            # A text has one word fewer after its first.
            ends = np.cumsum(np.concatenate([[0], lengths[codes]]))[np.cumsum(np.diff(bounds) - 1)]
            at = 0
            for i, head, end in zip(plain, heads, ends, strict=True):
                out[i] = np.concatenate([head, tail[at:end]])
                at = end
        lengths = np.array([len(x) for x in out], np.int64)
        return np.concatenate([np.empty(0, np.int32), *out]), lengths

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids. One character may be split over several tokens; the bytes join it again.

        An id outside the vocabulary is an error.
        """
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Start and end of each id's text in characters (code points), as rows of two.

        A token that holds part of a character covers that character whole, so neighbours may overlap there.
        """
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80)  # the number of the character each byte belongs to, from 1
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids.tolist()]).astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return np.stack([char[starts] - 1, char[ends - 1]], axis=1) if len(ends) else np.empty((0, 2), np.int64)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    """Once per Python worker and path. The file lies at the same path on every machine.

    A task has one core: the library's threads, one for each core of the machine, would each keep memory of their own.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteBpe(path)


def decimal(ids: np.ndarray) -> bytes:
    return " ".join(map(str, ids.tolist())).encode()


def _mapped(result: str, path: str, each):
    @F.arrow_udf(result)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = vocabulary(path)
        for batch in batches:
            # Results leave piece by piece, so a worker never holds those of a whole batch.
            for part in pieces(utf8(batch), BYTES_AT_ONCE, ROWS_AT_ONCE) if len(batch) else [utf8(batch)]:
                yield each(bpe, part)
            pa.default_memory_pool().release_unused()
    return run


def encode(text: Column, path: str, with_offsets: bool = False) -> Column:
    """A struct of `ids` array<int> and, on request, `starts` and `ends` array<int>, the characters of each id."""
    def each(bpe: ByteBpe, texts: pa.Array) -> pa.Array:
        ids, lengths = bpe.encode(texts)
        parts, names = [list_array(pa.array(ids, pa.int32()), lengths)], ["ids"]
        if with_offsets:
            own = np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []
            both = np.concatenate([np.empty((0, 2), np.int64), *[bpe.offsets(t, x) for t, x in zip(texts.to_pylist(), own, strict=True)]])
            parts += [list_array(pa.array(both[:, k], pa.int32()), lengths) for k in (0, 1)]
            names += ["starts", "ends"]
        return pa.StructArray.from_arrays(parts, names)
    more = ", starts: array<int>, ends: array<int>" if with_offsets else ""
    return _mapped(f"struct<ids: array<int>{more}>", path, each)(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes (binary) of an array<int> of ids; NULL gives no bytes."""
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = vocabulary(path)
        for batch in batches:
            yield pa.array([bpe.decode(np.asarray(x.values)) if x.is_valid else b"" for x in batch], pa.binary())
    return run(ids)


def round_trip_digest(text: Column, path: str) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256 of a text's ids and of the bytes they decode to."""
    def each(bpe: ByteBpe, texts: pa.Array) -> pa.Array:
        ids, lengths = bpe.encode(texts)
        own = np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []
        return pa.StructArray.from_arrays(
            [pa.array(lengths, pa.int64()), pa.array([hashlib.sha256(decimal(x)).hexdigest() for x in own], pa.string()),
             pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in own], pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"])
    return _mapped("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>", path, each)(text)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their ids in a further column, which replaces one of that name."""
    return docs.withColumn(ids_col, encode(F.col(text_col), path)["ids"])
