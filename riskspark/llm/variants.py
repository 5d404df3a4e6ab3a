"""Spelling variants: words one edit apart, by an index of grams of variable length.

Every word stands between two marks. A gram dictionary is built from all words: the grams of QMIN characters, and a
longer one, up to QMAX, only where the gram without its last character is frequent (more than one in
FREQUENT_GRAMS of all gram places), so that no list of words gets much longer than the others. At each place a
word has the one gram that goes on for as long as the dictionary does. An edit changes only grams that it lies in:
a word's bound is the largest number of its grams that lie over one character. So of two words one edit apart, all
but that many grams of each are also grams of the other, at the same place or one further where a character was
put in. In any order of grams the first that they share is therefore among the first bound + 1 of both. With rare
grams first, only these enter the index, by word length, place and gram; the short lists of equal entries are
merged and the words that meet are verified exactly. QMAX is at most the length of the shortest word, so a word
always has more grams than its bound, and none needs another way.

Only the frequent grams, at most FREQUENT_GRAMS for each length, go to the tasks; a longer gram is in the
dictionary if its beginning is. The words themselves, their lists and their links stay distributed.

A word's form is its near word with the largest count (ties: the first by code point), if that is at least RATIO
times its own; forms are followed to the last one by doubling steps, as many as the logarithm of the longest chain.

Rows with a NULL or empty text have no words. A NULL id is written as no characters. Repeated rows count each.
Empty tables give empty results. Further columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import materialise

LETTERS = "[A-Za-zÀ-ÿ]+"
#: One word in so many loses a character, by its checksum.
MISSPELT = 97
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
QMIN, QMAX = 2, 5
FREQUENT_GRAMS = 20_000
BEGIN, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts, after the checksum's deletions, that are long and frequent enough."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).filter(F.length("run") >= least_length)
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = rows.select(F.when(h % MISSPELT == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, most: int = FREQUENT_GRAMS) -> dict[str, int]:
    """The grams of QMIN to QMAX characters at more than one in `most` of all places, with their counts.

    A place is counted once for each length, so each length has fewer than `most` such grams. Those of QMAX
    characters go no further in any word; their counts are for the order.
    """
    s = F.concat(F.lit(BEGIN), F.col("word"), F.lit(END))
    places = F.sequence(F.lit(1), F.length(s) - QMIN + 1)
    grams = words.select(F.explode(F.flatten(F.transform(places, lambda p: F.transform(
        F.sequence(F.lit(QMIN), F.least(F.lit(QMAX), F.length(s) - p + 1)), lambda q: F.substring(s, p, q))))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("c"))
    total = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]
    return {r["gram"]: r["c"] for r in counts.filter(F.col("c") * most > total).collect()}


def decomposed(word: str, frequent: dict[str, int]) -> tuple[list[str], int]:
    """The gram at each place of the marked word, and how many of them can lie over one character."""
    s = BEGIN + word + END
    grams, over = [], [0] * (len(s) + 1)
    for p in range(len(s) - QMIN + 1):
        end = p + QMIN
        while end < len(s) and end - p < QMAX and s[p:end] in frequent:
            end += 1
        grams.append(s[p:end])
        over[p] += 1
        over[end] -= 1
    most = here = 0
    for change in over:
        here += change
        most = max(most, here)
    return grams, most


def entries(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(place, gram) of the word's rarest grams, bound + 1 of them, and all that are equal to one of these."""
    grams, bound = decomposed(word, frequent)
    # Infrequent grams first, the longer ones before: their lists are the shortest.
    order = sorted((frequent.get(g, 0), -len(g), g) for g in grams)
    last = order[min(bound, len(order) - 1)]
    return [(p, g) for p, g in enumerate(grams) if (frequent.get(g, 0), -len(g), g) <= last]


def letters(word: str) -> int:
    """A bit for each character that occurs, 64 in all, as a signed number; one edit changes two at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def gram_index(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, letters, length, place, gram) of the entries of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, length, place, gram = [], [], [], []
            words = batch.column("word").to_pylist()
            masks = pa.array(list(map(letters, words)), pa.int64())
            for i, word in enumerate(words):
                for p, g in entries(word, frequent):
                    row.append(i)
                    length.append(len(word))
                    place.append(p)
                    gram.append(g)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({"word": batch.column("word").take(at), "n": batch.column("n").take(at), "letters": masks.take(at), "length": pa.array(length, pa.int32()),
                                              "place": pa.array(place, pa.int32()), "gram": pa.array(gram, pa.string())})
    return words.select("word", "n").mapInArrow(run, "word string, n long, letters long, length int, place int, gram string")


def near_words(words: DataFrame, most: int = FREQUENT_GRAMS) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of words (word, n) one edit apart, each once. Words have QMAX characters or more."""
    index = materialise(gram_index(words, frequent_grams(words, most)), "variant-index")
    # A word asks among words of its length, and as the shorter one among those with a character more.
    asked = F.explode(F.array(*[F.struct((F.col("length") + i).alias("length"), (F.col("place") + j).alias("place")) for i, j in ((0, 0), (1, 0), (1, 1))]))
    asks = index.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_letters"), "gram", asked.alias("at"))
    asks = asks.select("a", "a_n", "a_letters", "gram", F.col("at.length").alias("length"), F.col("at.place").alias("place"))
    lists = index.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_letters"), "gram", "length", "place")
    other = (F.length("a") < F.col("length")) | (F.col("a") < F.col("b"))
    # The letters that occur rule most words out before the distance is taken.
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    met = asks.join(lists, ["gram", "length", "place"]).filter(alike & other & (_distance(F.col("a"), F.col("b")) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def _distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1)


def groups(words: DataFrame, most: int = FREQUENT_GRAMS, ratio: int = RATIO) -> DataFrame:
    """Every word with its form, root, n, n_near and form_n, from (word, n)."""
    words = materialise(words.select("word", "n"), "variant-words")
    pairs = materialise(near_words(words, most), "variant-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best"))
    near = best.select(F.col("a").alias("word"), "n_near", F.col("best.word").alias("other"), (-F.col("best.n")).alias("other_n"))
    has = F.col("other_n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                    F.when(has, F.col("other")).alias("form"), F.when(has, F.col("other_n")).alias("form_n"))
    formed = materialise(formed, "variant-forms")
    roots = last_forms(formed.filter("form is not null").select("word", "form"))
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), forms being a forest: every round each word's form becomes its form's form."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = materialise(step, "variant-roots")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of the documents."""
    return groups(word_counts(docs, id_col, text_col))
