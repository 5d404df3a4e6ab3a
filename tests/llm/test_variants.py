"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from riskspark.llm import variants
from tests.llm.plain import one_edit_apart


def plain_counts(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def plain_groups(count):
    words, near = sorted(count), {w: [] for w in count}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), count[w], len(near[w]), count[form[w]] if form[w] else None) for w in words}


def some_words(seed, n=400, letters="abcñ"):
    rng, out = random.Random(seed), {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        out[w] = rng.randint(3, 200)
        at = rng.randrange(len(w))
        for v in (w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]):
            if len(v) >= 5:
                out.setdefault(v, rng.randint(3, 40))
    return out


def result(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("most", [1, 50, 10**9])
def test_groups_are_those_of_all_pairs(spark, most):
    count = some_words(most % 97)
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    got = variants.groups(df, most)
    assert result(got) == plain_groups(count) and got.count() == len(count)


def test_a_word_has_more_grams_than_its_bound():
    for word in [*some_words(5), "a" * 5, "a" * 40]:
        for frequent in ({}, {word[i:j]: 1 for i in range(len(word)) for j in range(i + 2, i + 5)}):
            grams, bound = variants.decomposed(word, frequent)
            assert 0 < bound < len(grams) == len(word) + 1
            assert len(variants.entries(word, frequent)) > bound


def test_chains_of_forms_are_followed_to_the_last(spark):
    # Each word is one edit from the next, whose count is twice as large.
    words = ["a" * i + "b" * (12 - i) for i in range(13)]
    df = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(words)], "word string, n long")
    assert {r.root for r in variants.groups(df).collect()} == {words[-1]}


def test_ties_go_to_the_smaller_word(spark):
    df = spark.createDataFrame([("house", 3), ("mouse", 10), ("louse", 10), ("horse", 10)], "word string, n long")
    got = {r.word: r for r in variants.groups(df).collect()}
    assert got["house"].form == "horse" and got["house"].n_near == 3 and got["mouse"].form is None


def test_words_of_odd_documents(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert {(r.word, r.n) for r in variants.word_counts(odd).collect()} == set(plain_counts(rows).items())
    assert result(variants.spelling_variants(odd)) == plain_groups(plain_counts(rows))
    assert variants.spelling_variants(none).collect() == []


def test_case_and_deletions(spark):
    # Only A to Z is lower-cased; É stays.
    rows = [(i, "ÉCOLE Straße écOle") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.word, r.n) for r in variants.word_counts(df).collect()}
    assert got == set(plain_counts(rows).items())
    assert {"École", "straße", "école"} <= {w for w, _ in got}


def test_the_query_equals_all_pairs(spark):
    from riskspark.llm.queries import QUERIES
    from riskspark.llm.text import table
    folder = "/root/testdata/sf0.001"
    count = plain_counts([(r.doc_id, r.text) for r in table(spark, folder, "documents").select("doc_id", "text").collect()])
    got = QUERIES["op13_variable_gram_variants"](spark, folder)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == plain_groups(count)
