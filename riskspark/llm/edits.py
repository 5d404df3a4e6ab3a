"""Token counts that follow edits: a segment tree of pre-tokens per document.

The leaves are the document's pre-tokens, each with its length in characters and its number of tokens; they lie
in blocks, and a binary tree over the blocks holds the sums of both. An edit replaces the characters from `at` to
`end` by a text. The tree finds the pre-token there; splitting starts CONTEXT pre-tokens earlier, as a pre-token
depends on the two characters after it, and goes on until a new boundary after the edit meets an old one: from
there on text and boundaries are as before. Only the pre-tokens in between are encoded again, and only the sums
above their blocks change.

Leaves can be kept as a column (`leaves`), so that later edits of a stored document encode no more than that
(`edited`). Edits of one document are applied in the given order, each to the text that the earlier ones left;
positions beyond the text are moved to its end, NULL positions are 0 (`at`) or `at` (`end`), an end before its
start is the start, a NULL replacement is empty. NULL texts and NULL lists of edits are empty. Repeated rows get
equal results; empty tables give empty ones. Further columns pass through untouched.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT = 3
BLOCK = 64
#: Counts of different pre-tokens kept by a worker, to bound its memory.
KEPT = 400_000
EDIT = "struct<at: int, end: int, text: string>"


class Counter:
    """Splits text into pre-tokens and counts the tokens of each."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, pre_tokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > KEPT:
            known.clear()
        for p in set(pre_tokens).difference(known):
            known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in pre_tokens]


@functools.lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    """Once per Python worker."""
    return Counter(path, pattern)


class Tree:
    """Blocks of leaves (lengths and token counts), and a binary tree of their sums: node i is over 2i and 2i + 1."""

    def __init__(self, lengths: list[int], tokens: list[int]):
        self._build([[lengths[i : i + BLOCK], tokens[i : i + BLOCK]] for i in range(0, len(lengths), BLOCK)] or [[[], []]])

    def _build(self, blocks: list[list[list[int]]]) -> None:
        self.blocks, self.width = blocks, 1 << (len(blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (lengths, tokens) in enumerate(blocks):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(lengths), sum(tokens)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int, int]:
        """Block and place of the leaf that holds character `at` (the last leaf, if beyond), and where it starts."""
        at, start, i = min(at, max(self.chars[1] - 1, 0)), 0, 1
        while i < self.width:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        block, place = i - self.width, 0
        lengths = self.blocks[block][0] if block < len(self.blocks) else []
        while place < len(lengths) and at - start >= lengths[place]:
            start += lengths[place]
            place += 1
        return block, place, start

    def back(self, block: int, place: int, start: int, steps: int) -> tuple[int, int, int]:
        while steps and (block or place):
            if not place:
                block -= 1
                place = len(self.blocks[block][0])
                continue
            place -= 1
            start -= self.blocks[block][0][place]
            steps -= 1
        return block, place, start

    def walk(self, block: int, place: int) -> Iterator[tuple[int, int, int]]:
        """Leaves from here on: block, place, length."""
        for b in range(block, len(self.blocks)):
            for p in range(place if b == block else 0, len(self.blocks[b][0])):
                yield b, p, self.blocks[b][0][p]

    def replace(self, first: tuple[int, int], after: tuple[int, int], lengths: list[int], tokens: list[int]) -> None:
        """Put new leaves where the old ones from `first` up to before `after` were."""
        (b, p), (c, q) = first, after
        for kind, new in ((0, lengths), (1, tokens)):
            tail = self.blocks[c][kind][q:] if c < len(self.blocks) else []
            if b == c:
                self.blocks[b][kind][p:] = new + tail
            else:
                self.blocks[b][kind][p:] = new
                for i in range(b + 1, min(c, len(self.blocks))):
                    self.blocks[i][kind].clear()
                if c < len(self.blocks):
                    self.blocks[c][kind][:] = tail
        if len(self.blocks[b][0]) > 4 * BLOCK:
            self.__init__([x for lengths, _ in self.blocks for x in lengths], [x for _, tokens in self.blocks for x in tokens])
            return
        touched = {self.width + i for i in range(b, min(c, len(self.blocks) - 1) + 1)}
        for i in touched:
            self.chars[i], self.tokens[i] = sum(self.blocks[i - self.width][0]), sum(self.blocks[i - self.width][1])
        while touched := {i // 2 for i in touched if i > 1}:
            for i in touched:
                self._sum(i)


class Document:
    """A text with its tree. `encoded` is the number of characters encoded since the start."""

    def __init__(self, counter: Counter, text: str, lengths: list[int] | None = None, tokens: list[int] | None = None):
        self.counter, self.text, self.encoded = counter, text, 0
        if lengths is None or tokens is None:
            parts = counter.split.findall(text)
            lengths, tokens, self.encoded = [len(p) for p in parts], counter.count(parts), len(text)
        self.tree = Tree(lengths, tokens)

    def edit(self, at: int | None, end: int | None, new: str | None) -> None:
        at = min(max(at or 0, 0), len(self.text))
        end = min(max(at if end is None else end, at), len(self.text))
        new = new or ""
        self.text = self.text[:at] + new + self.text[end:]
        more = len(new) - (end - at)
        block, place, start = self.tree.back(*self.tree.find(at), CONTEXT)
        fresh: list[str] = []
        now, safe = start, at + len(new)
        old, where = start, (len(self.tree.blocks), 0)
        leaves = self.tree.walk(block, place)
        leaf = next(leaves, None)
        matches = self.counter.split.finditer(self.text, start)
        while True:
            while leaf and (old < end or old + more < now):  # the first old boundary not before the new one
                old += leaf[2]
                leaf = next(leaves, None)
            if now >= safe and old + more == now:
                where = (leaf[0], leaf[1]) if leaf else where
                break
            match = next(matches, None)
            if match is None:
                break
            fresh.append(match.group())
            now = match.end()
        self.tree.replace((block, place), where, [len(p) for p in fresh], self.counter.count(fresh))
        self.encoded += now - start

    def leaves(self) -> tuple[list[int], list[int]]:
        return [x for b in self.tree.blocks for x in b[0]], [x for b in self.tree.blocks for x in b[1]]


def leaves(text: Column, path: str, pattern: str) -> Column:
    """Struct of n_tokens, and of the pre-tokens' lengths and tokens (array<int>), to be kept with the document."""
    @F.arrow_udf("struct<n_tokens: bigint, lengths: array<int>, tokens: array<int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(path, pattern)
        for batch in batches:
            docs = [Document(c, t.as_py() or "") for t in batch]
            both = [d.leaves() for d in docs]
            yield pa.StructArray.from_arrays(
                [pa.array([d.tree.total() for d in docs], pa.int64()), pa.array([b[0] for b in both], pa.list_(pa.int32())), pa.array([b[1] for b in both], pa.list_(pa.int32()))],
                ["n_tokens", "lengths", "tokens"])
    return run(text)


def edited(text: Column, kept: Column, edits: Column, path: str, pattern: str) -> Column:
    """Apply array<EDIT> to documents whose `leaves` are kept: struct of text, n_tokens, lengths, tokens, and the
    characters encoded for it."""
    @F.arrow_udf("struct<text: string, n_tokens: bigint, lengths: array<int>, tokens: array<int>, encoded: bigint>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        c = counter(path, pattern)
        for texts, trees, lists in batches:
            out = []
            for t, tree, todo in zip(texts, trees, lists, strict=True):
                tree = tree.as_py()
                d = Document(c, t.as_py() or "", tree["lengths"], tree["tokens"])
                for e in todo.as_py() or []:
                    d.edit(e["at"], e["end"], e["text"])
                lengths, tokens = d.leaves()
                out.append({"text": d.text, "n_tokens": d.tree.total(), "lengths": lengths, "tokens": tokens, "encoded": d.encoded})
            yield pa.array(out, pa.struct([("text", pa.string()), ("n_tokens", pa.int64()), ("lengths", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32())), ("encoded", pa.int64())]))
    return run(text, kept, edits)


def counts(text: Column, edits: Column, path: str, pattern: str) -> Column:
    """Struct of n_tokens, n_tokens_after the array<EDIT>, n_chars_encoded for the edits, of a whole text."""
    @F.arrow_udf("struct<n_tokens: bigint, n_tokens_after: bigint, n_chars_encoded: bigint>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        c = counter(path, pattern)
        for texts, lists in batches:
            rows: list[tuple[int, int, int]] = []
            for t, todo in zip(texts, lists, strict=True):
                d = Document(c, t.as_py() or "")
                before, whole = d.tree.total(), d.encoded
                for e in todo.as_py() or []:
                    d.edit(e["at"], e["end"], e["text"])
                rows.append((before, d.tree.total(), d.encoded - whole))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["n_tokens", "n_tokens_after", "n_chars_encoded"])
    return run(text, edits)
