"""SentencePiece BPE with a prefix table: encoding in time linear in the text, and decoding.

The library normalises a text (white space becomes U+2581). Merging pieces by score leaves, for every prefix of
the text, one last piece, and it is the same whatever follows. A table holds it for each prefix: of the pieces
that an automaton finds to end there, it is the one that is compatible with the last piece of the prefix before
it, that is, merging the two pieces' characters alone gives these two pieces again. The ids are read off the table
from the end of the text backwards. A character that no piece holds stands alone and becomes its bytes.

Where no piece has U+2581 after another character, nothing merges across such a place: the text is cut there and
each distinct word of a batch has one table; a worker keeps the ids of the words it has met. Decoding is the
library's.

NULL texts count as empty and give no ids. Ties and repeated rows need no rule: every row is encoded alone. Other
columns pass through untouched, whatever they are called. An empty table gives an empty one. Models need byte
pieces, and may have no unused and no user-defined pieces.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.text import list_array, pieces, ragged, raw, utf8

SPACE = "▁"
#: Text and rows that a worker encodes at once.
BYTES_AT_ONCE, ROWS_AT_ONCE = 2 << 20, 2048
#: Words whose ids, and pairs of pieces whose test, a worker keeps; and the longest word kept.
WORDS_KEPT, PAIRS_KEPT, EDGES_KEPT, LONGEST_KEPT = 200_000, 300_000, 50_000, 64
NEVER = float("-inf")


class PieceBpe:
    """One model file."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self.byte_ids)) or any(map(sp.is_unused, every)):
            raise ValueError("the model has no byte pieces, or has unused pieces")
        own = [i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.id_of = {sp.id_to_piece(i): i for i in own}
        self.score = {piece: sp.get_score(i) for piece, i in self.id_of.items()}
        self.cuts = not any(SPACE in piece.lstrip(SPACE) for piece in self.id_of)
        self.edges: dict[str, tuple] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        # A piece that merging its own characters does not give is never in a result.
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            if self._edges(piece)[-1]:
                self.automaton.add_word(piece, (len(piece), piece))
        self.automaton.make_automaton()
        self._forget()

    def merged(self, text: str) -> list[str]:
        """What merging leaves of a short text's characters: the best score first, of equal ones the leftmost."""
        parts, score = list(text), self.score
        while True:
            found = [(score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
            if not found:
                return parts
            at = -max(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _edges(self, piece: str) -> tuple[list[str], list[float], list[str], list[float], bool, bool]:
        """How the piece's characters merge: the symbols at its right edge in the order in which they come, with the
        scores of their merges (no score ends the list); those at its left edge; whether scores never rise on the
        way; whether the piece itself comes out.
        """
        known = self.edges.get(piece)
        if known is None:
            parts, score, steps = list(piece), self.score, []
            right, left = [parts[-1]], [parts[0]]
            right_scores, left_scores = [], []
            while True:
                found = [(score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
                if not found:
                    break
                best, at = max(found)
                at = -at
                both = parts[at] + parts[at + 1]
                if at + 2 == len(parts):
                    right.append(both)
                    right_scores.append(best)
                if at == 0:
                    left.append(both)
                    left_scores.append(best)
                parts[at : at + 2] = [both]
                steps.append(best)
            ordered = all(a >= b for a, b in zip(steps, steps[1:]))
            known = (right, [*right_scores, NEVER], left, [*left_scores, NEVER], ordered, len(parts) == 1)
            if len(self.edges) < EDGES_KEPT:
                self.edges[piece] = known
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Do the two pieces stay as they are, side by side?

        While both merge, by falling scores, the symbols that meet at their border change one at a time. A merge
        across the border comes before the next change if its score is higher; of equal ones the left comes first.
        """
        fit = self.fits.get((a, b))
        if fit is None:
            if len(self.fits) > PAIRS_KEPT:
                self.fits.clear()
            right, right_scores, _, _, falling, _ = self._edges(a)
            _, _, left, left_scores, falling_too, _ = self._edges(b)
            if falling and falling_too:
                i = j = 0
                while True:
                    across, x, y = self.score.get(right[i] + left[j], NEVER), right_scores[i], left_scores[j]
                    if across > x and across >= y and across != NEVER:
                        fit = False
                        break
                    if x == NEVER and y == NEVER:
                        fit = True
                        break
                    if x >= y:
                        i += 1
                    else:
                        j += 1
            else:
                fit = self.merged(a + b) == [a, b]
            self.fits[a, b] = fit
        return fit

    def prefix_table(self, word: str) -> list[str]:
        """The last piece of each prefix of the word, from the empty one (''); '' where it is a character of no piece."""
        last, fits = [""] * (len(word) + 1), self.fits
        for at, (size, piece) in self.automaton.iter(word):
            if last[at + 1]:
                continue
            start = at + 1 - size
            if start:
                before = last[start] or word[start - 1]
                fit = fits.get((before, piece))
                if not (self.compatible(before, piece) if fit is None else fit):
                    continue
            last[at + 1] = piece
        return last

    def word_ids(self, word: str) -> list[int]:
        last, at, ids = self.prefix_table(word), len(word), []
        while at:
            piece = last[at]
            if piece:
                ids.append(self.id_of[piece])
                at -= len(piece)
            else:
                at -= 1
                ids.extend(self.byte_ids[b] for b in reversed(word[at].encode()))
        ids.reverse()
        return ids

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.begins, self.lengths, self.pool = array("q"), array("q"), array("i")

    def _known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool each of these distinct words' ids begin, and how many it has."""
        if len(self.places) > WORDS_KEPT:
            self._forget()
        places, at_of = self.places, []
        for word in words:
            at = places.get(word, -1)
            if at < 0:
                at = places[word] = len(self.begins)
                ids = self.word_ids(word)
                self.begins.append(len(self.pool))
                self.lengths.append(len(ids))
                self.pool.extend(ids)
            at_of.append(at)
        place = np.array(at_of, np.int64)
        # Copies: an array that is looked at cannot grow.
        return np.array(self.begins, np.int64)[place], np.array(self.lengths, np.int64)[place]

    def _coded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end, and how many each has. Long words pass by the pool."""
        coded = words.dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        long = [k for k, w in enumerate(distinct) if len(w) > LONGEST_KEPT]
        begins, lengths = self._known(["" if len(w) > LONGEST_KEPT else w for w in distinct])
        pool = np.array(self.pool, np.int32)
        if long:
            extra = [np.array(self.word_ids(distinct[k]), np.int32) for k in long]
            sizes = np.array([len(x) for x in extra])
            begins[long] = np.cumsum(sizes) - sizes + len(pool)
            lengths[long] = sizes
            pool = np.concatenate([pool, *extra])
        word, place = ragged(lengths[codes])
        return (pool[begins[codes][word] + place] if len(word) else np.empty(0, np.int32)), lengths[codes]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (large strings, no NULL) end to end, and how many each has."""
        normal = pa.array(self.library.normalize(texts.to_pylist()), pa.large_string())
        flat, starts = raw(normal)
        cut = np.zeros(len(flat) + 1, bool)
        if self.cuts and len(flat) > 2:
            space = np.zeros(len(flat) + 3, bool)
            space[3:-2] = (flat[:-2] == 0xE2) & (flat[1:-1] == 0x96) & (flat[2:] == 0x81)
            cut[: len(flat)] = space[3:] & ~space[:-3]
        cut[starts] = True
        # An empty text has no word; the end of the last text is no word's start.
        begin = np.flatnonzero(cut[: len(flat)])
        offsets = np.append(begin, len(flat)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat)))
        ids, each = self._coded(words) if len(begin) else (np.empty(0, np.int32), np.empty(0, np.int64))
        ends = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(begin, starts)]
        return ids, np.diff(ends)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def model(path: str) -> PieceBpe:
    """Once per Python worker and path. The file lies at the same path on every machine."""
    return PieceBpe(path)


def _mapped(result: str, path: str, each):
    @F.arrow_udf(result)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model(path)
        for batch in batches:
            for part in pieces(utf8(batch), BYTES_AT_ONCE, ROWS_AT_ONCE) if len(batch) else [utf8(batch)]:
                yield each(own, part)
            pa.default_memory_pool().release_unused()
    return run


def encode(text: Column, path: str) -> Column:
    """array<int> of a text's ids."""
    def each(own: PieceBpe, texts: pa.Array) -> pa.Array:
        ids, lengths = own.encode(texts)
        return list_array(pa.array(ids, pa.int32()), lengths)
    return _mapped("array<int>", path, each)(text)


def decode(ids: Column, path: str) -> Column:
    """The text of an array<int> of ids; NULL gives an empty one."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model(path)
        for batch in batches:
            yield pa.array([own.decode(x.as_py()) if x.is_valid else "" for x in batch], pa.string())
    return run(ids)


def round_trip_digest(text: Column, path: str) -> Column:
    """Struct of n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of a text."""
    def each(own: PieceBpe, texts: pa.Array) -> pa.Array:
        ids, lengths = own.encode(texts)
        out: list[tuple[str, str]] = []
        for x in np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []:
            x = x.tolist()
            out.append((hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(own.decode(x).encode()).hexdigest()))
        return pa.StructArray.from_arrays(
            [pa.array(lengths, pa.int64()), *[pa.array([x[k] for x in out], pa.string()) for k in (0, 1)]], ["n_tokens", "ids_sha256", "decoded_sha256"])
    return _mapped("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>", path, each)(text)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their ids in a further column, which replaces one of that name."""
    return docs.withColumn(ids_col, encode(F.col(text_col), path))
