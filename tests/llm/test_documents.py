"""Mixing, personal data, near-duplicates, classifiers and the pipeline against plain versions."""

import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import bytecnn, centroid, dart, pii, pivotal
from riskspark.llm.queries import QUERIES as LLM_QUERIES
from riskspark.llm.text import utf8

SF = "/root/testdata/sf0.001"


# Mixing

def shared_out(sizes, weights, cap):
    """The contract's rule, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        rate = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if rate * weight[s] > cap * sizes[s]}
        if not above:
            return out | {s: rate * weight[s] for s in open_}
        for s in above:
            out[s] = float(cap * sizes[s])
            rest -= out[s]
        open_ -= above
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "é": 10, None: 400}, {"a": 10}, {"a": 0, "b": 10}])
def test_targets_follow_the_rule(spark, sizes):
    rows = pivotal.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = shared_out(sizes, (5, 2, 1), 3)
    assert {r.source: pytest.approx(r.target) for r in rows} == want


def test_rounding_keeps_the_mass_and_the_chances(spark):
    units = spark.range(3000).select((F.col("id") % 3).cast("string").alias("group"), F.col("id").alias("key"), F.lit(0.3).alias("p"), (1.0 + F.col("id") % 50).alias("w"))
    mass = {r.group: r.m for r in units.groupBy("group").agg(F.sum(F.col("p") * F.col("w")).alias("m")).collect()}
    shares = []
    for seed in range(3):
        taken = pivotal.pivotal_round(units, seed).join(units, ["group", "key"])
        assert taken.count() == 3000 and taken.filter("taken not in (0, 1)").count() == 0
        for r in taken.groupBy("group").agg(F.sum(F.col("taken") * F.col("w")).alias("m"), F.avg("taken").alias("share")).collect():
            assert abs(r.m - mass[r.group]) < 50
            shares.append(r.share)
    assert abs(np.mean(shares) - 0.3) < 0.03


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_sources_come_near_their_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    plan = pivotal.mix_plan(docs).cache()
    got = plan.groupBy("source").agg(F.max("target").alias("target"), F.sum(F.col("copies") * F.col("size") * F.col("m")).alias("taken"),
                                     F.median("size").alias("median"), F.max("size").alias("longest")).collect()
    assert len(got) >= 10
    for r in got:
        assert abs(r.taken - r.target) <= r.median, r
    # Every document keeps its expected copies: by size, the share taken is that of the source.
    long = plan.filter("size > 0").select("size", "copies", (F.col("target") / F.col("source_size")).alias("rate"))
    for low, high in ((1, 50), (50, 500), (500, 10**9)):
        own = long.filter((F.col("size") >= low) & (F.col("size") < high)).agg(F.avg(F.col("copies") - F.col("rate")).alias("d"), F.count("*").alias("n")).first()
        assert abs(own.d) < 3 / own.n**0.5


def test_a_source_of_one_long_and_many_short_documents(spark):
    rows = [(i, "w " * n, s) for s, sizes in (("a", [5000] + [10] * 2000), ("b", [40] * 700)) for i, n in enumerate(sizes, 10000 * ord(s))]
    misses = []
    for seed in range(4):
        plan = pivotal.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed)
        got = plan.groupBy("source").agg(F.max("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
        misses += [abs(r.taken - r.target) for r in got]
    assert max(misses) <= 40


def test_phases_go_from_long_to_short(spark):
    units = spark.createDataFrame([("a", i, 0.5, float(w)) for i, w in enumerate([5000, 900] + [100] * 40 + [8] * 300 + [1] * 5)] + [("b", 999, 0.5, 7.0)], "group string, key long, p double, w double")
    got = {(r.group, r["size"]): r.phase for r in pivotal.phases(units).collect()}
    assert got == {("a", 12): 0, ("a", 9): 0, ("a", 6): 1, ("a", 3): 2, ("a", 0): 2, ("b", 2): 0}
    taken = pivotal.rounded(units)
    assert taken.count() == units.count() and taken.filter("taken is null or taken not in (0, 1)").count() == 0
    miss = taken.join(units, "key").agg(F.sum((F.col("taken") - F.col("p")) * F.col("w"))).first()[0]
    assert abs(miss) < 8 + 7


def test_mix_on_odd_rows(odd, none):
    plan = pivotal.mix_plan(odd).withColumn("taken", F.col("copies") * F.col("size")).collect()
    again = pivotal.mix_plan(odd).collect()
    assert sorted(map(str, [r[:6] for r in plan])) == sorted(map(str, [r[:6] for r in again]))
    words = Counter()
    for r in odd.collect():
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert all(r.source_size == words[r.source] and r.taken <= 3 * r.size for r in plan)
    want = shared_out(dict(words), (5, 2, 1), 3)
    assert {r.source: pytest.approx(r.target) for r in plan} == want
    mixed = pivotal.mixed_documents(odd)
    copies = {(r.doc_id, r.source, r.size): r.copies * r.m for r in plan}
    assert mixed.columns == odd.columns and mixed.count() == sum(copies.values())
    assert pivotal.mix_plan(none).collect() == [] and pivotal.mixed_documents(none).collect() == []


# Personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TRICKY = [
    "mail a@b.c%d@e.f or a@b@c.d, not a@b; 1.2.3.4.5.6.7.8 and 256.1.1.1, 001.02.3.255 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 and 79927398713",
    "+1 (988) 555-2485 +49 30 1234567. +1 2 +12345678901234567890", "🙂é x@y.zz 中文 10.0.0.1", "x@y.z" * 50, "1 2 3 4 " * 40, "a" * 20000 + "@" + "b.c" * 5000,
    "+" * 500 + "1" * 500, "7" * 30000, "", "a.b@c..d e@f.g", "\n4012888888881881\t+44 20 7946 0958"]


def base_spans(text):
    def ok(kind, x):
        d = re.sub("[^0-9]", "", x)
        luhn = sum((lambda v: v - 9 if v > 9 else v)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in x.split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]
    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if ok(k, m.group()))


def test_base_spans_are_the_contract_s(spark, odd, none):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    rows = pii.find(df).collect()
    seen = Counter(tuple(map(tuple, r.base)) for r in rows)
    assert seen == Counter(tuple(base_spans(t or "")) for t in [*TRICKY, *[r.text for r in odd.collect()]])
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in rows) and len(texts) > 5
    assert pii.find(none).collect() == []


def test_query_counts_the_spans_of_each_kind(spark, odd, tmp_path):
    texts = TRICKY + ["10.0.0.1 10.0.0.2 a@b.cd", "4111 1111 1111 1111", "+1 (988) 555-2485 +49 30 1234567 1.2.3.4", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = LLM_QUERIES["op7_weak_supervision_pii"](spark, str(tmp_path)).collect()
    want = Counter()
    for r in df.collect():
        spans = base_spans(r.text or "")
        digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
        want[(r.doc_id, *[sum(k == kind for _, k, _ in spans) for kind in range(4)], digest)] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want


def test_supervision_adds_what_the_patterns_miss(spark):
    rows = [f"Please contact us: phone +1 (988) 555-{i:04d} or mail a{i}@b.com today" for i in range(60)]
    rows += [f"isbn {i:04d} 1234 and version 1.2.3.{300 + i} with order {1234567 + i} in it" for i in range(60)]
    hidden = ["Please phone (212) 555-0199 for it", "mail: joe [at] site [dot] com", "ssn 123-45-6789 is mine"]
    df = spark.createDataFrame(list(enumerate(rows + hidden)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(df).collect()}
    assert [len(found[len(rows) + i]) for i in range(3)] == [1, 1, 1]
    assert all(len(found[i]) == 2 for i in range(60)) and not any(found[i] for i in range(60, 120))
    text = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert text[0] == "Please contact us: phone [PHONE] or mail [EMAIL] today" and text[len(rows)] == "Please phone [PHONE] for it" and text[70] == rows[70]


def test_expectation_maximisation_finds_the_reliable_labelers(spark):
    rng = np.random.default_rng(1)
    truth = rng.random(2000) < 0.4
    votes = np.stack([np.where(rng.random(2000) < share, np.where(truth, 1, -1), np.where(truth, -1, 1)) for share in (0.95, 0.9, 0.9, 0.5, 0.5, 0.5)], axis=1)
    df = spark.createDataFrame([(v.tolist(), ["x"]) for v in votes], "votes array<int>, features array<string>")
    p = {tuple(r.votes): r.p for r in pii.posteriors(df).collect()}
    right = np.mean([(p[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert right > 0.95


def test_masking_joins_touching_spans(spark):
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(k).alias("kind"), F.lit(b).alias("end")) for a, k, b in ((0, 0, 3), (2, 1, 5), (5, 2, 6), (8, 3, 9))])
    assert spark.range(1).select(pii.masked(F.lit("abcdefgh🙂j"), spans)).collect()[0][0] == "[EMAIL][CARD]gh[PHONE]j"


# Near-duplicates

def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and len(x & y) >= 0.8 * len(x | y):
                low, high = sorted((top(i), top(j)))
                up[high] = low
    return {i: top(i) for i in up}


def near_rows():
    rng = np.random.default_rng(2)
    rows = []
    for g in range(12):
        base = [f"w{rng.integers(5000)}" for _ in range(int(rng.integers(3, 200)))]
        rows += [" ".join(base)] * 3
        for _ in range(15):
            words = list(base)
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(len(words)))] = f"x{rng.integers(5000)}"
            rows.append(" ".join(words))
    return [*enumerate([*rows, None, "", " ", "One two", "one  TWO", "a b c d e f " * 3000])]


def test_classes_are_those_of_brute_force(spark):
    rows = near_rows()
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_small_tables_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.class_id for r in dart.near_duplicates(docs).collect()} == want


def edited_copies():
    """200 copies of a text that isn't among them; most have three edits and are alike only to the few with one."""
    rng = np.random.default_rng(11)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(200):
        words = list(base)
        for at in rng.choice(200, 1 if i % 25 == 0 else 3, replace=False):
            words[at] = f"x{i}y{at}"
        rows.append(" ".join(words))
    return list(zip(rng.permutation(200).tolist(), rows, strict=True))


def test_members_of_a_large_bucket_meet_those_of_other_classes(spark):
    rows = edited_copies()
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_edits_of_one_document_alone_cost_no_pairs(spark, monkeypatch):
    """Copies of a base, many edited beyond the similarity: only those that may be alike are compared."""
    rng = np.random.default_rng(3)
    base, rows = [f"w{i}" for i in range(150)], [" ".join(f"w{i}" for i in range(150))]
    for i in range(400):
        words = list(base)
        for at in rng.choice(150, int(rng.integers(0, 12)), replace=False):
            words[at] = f"x{i}y{at}"
        rows.append(" ".join(words))
    rows = list(zip(rng.permutation(len(rows)).tolist(), rows, strict=True))
    made, compared = [], dart._open_pairs
    monkeypatch.setattr(dart, "_open_pairs", lambda *a: made.append(compared(*a)) or made[-1])
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) and made[0].count() < len(rows)


@pytest.mark.parametrize("shape", ["shared additions", "insertions and cuts", "two bases"])
def test_links_around_a_centre_are_all_found(spark, shape):
    """Classes that hang together only by texts that are alike beyond their centre, or through their sizes."""
    rng, rows = np.random.default_rng(4), []
    base = [f"w{i}" for i in range(160)]
    for i in range(160):
        words = list(base)
        if shape == "shared additions":
            words += [f"g{i % 12}z{k}" for k in range(48)]
            words[int(rng.integers(160))] = f"x{i}"
        elif shape == "insertions and cuts":
            if i % 2:
                words += [f"i{i}z{k}" for k in range(int(rng.integers(5, 40)))]
            else:
                words = words[: 160 - int(rng.integers(0, 40))]
        else:
            words = words[: 150 + i % 10] if i % 2 else [*words[:125], *[f"v{k}" for k in range(35)]]
            for at in rng.choice(len(words), int(rng.integers(0, 5)), replace=False):
                words[at] = f"x{i}y{at}"
        rows.append((i * 7 % 1000, " ".join(words)))
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_copies_by_count_are_compared_by_count(spark):
    a, b = " ".join(f"w{i % 20}" for i in range(400)), " ".join(f"w{i % 20}" for i in range(100))
    df = spark.createDataFrame([(1, a), (2, b), (3, a + " w0"), (4, b + " z")], "doc_id long, text string")
    classes = lambda by_count: {r.doc_id: r.class_id for r in dart.near_duplicates(df, by_count=by_count).collect()}
    assert classes(False) == {1: 1, 2: 1, 3: 1, 4: 1} and classes(True) == {1: 1, 2: 2, 3: 1, 4: 2}


def test_windows_of_long_texts_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    some = ["".join(rng.choice(list("ab \n"), int(n))) for n in rng.integers(0, 400, 60)] + ["x" * 300, "", "y" * 100 + " " + "z" * 50]
    whole = dart.shingles(utf8(pa.array(some)))
    for size in (1, 7, 64):
        monkeypatch.setattr(dart, "WINDOW", size)
        assert all((x == y).all() for x, y in zip(whole, dart.shingles(utf8(pa.array(some))), strict=True))


def test_ids_that_repeat_and_rows_without_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text("a")), (1, text("b")), (2, text("a") + " more"), (None, text("b")), (None, text("c")), (None, text("c")), (3, None), (None, " "), (4, text("d")), (4, text("d"))]
    docs = spark.createDataFrame([(*r, {"k": 1}, "x") for r in rows], "doc_id long, text string, extra map<string, int>, class string")
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in dart.near_duplicates(docs).collect())
    assert got == sorted([(1, 1), (1, 1), (2, 1), (0, 1), (0, 0), (0, 0), (3, 3), (0, 0), (4, 4), (4, 4)])
    kept = dart.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, text("a")), (1, text("b")), (None, text("c")), (3, None), (None, " "), (4, text("d"))])


def test_near_duplicates_on_odd_rows(odd, none):
    got = Counter((r.doc_id, r.class_id) for r in dart.near_duplicates(odd).collect())
    assert sum(got.values()) == odd.count() and got[(None, None)] == 1 and got[(None, 4)] == 1 and got[(4, 4)] == 2 and got[(5, 4)] == 1
    assert all(got[(i, i)] == 1 for i in (0, 1, 2, 3)) and dart.near_duplicates(none).collect() == []


@pytest.mark.parametrize("by_count", [False, True])
def test_agreement_of_signatures_is_the_weighted_similarity(by_count):
    a, b = " ".join(f"w{i % 40}" for i in range(120)), " ".join(f"w{i % 40}" for i in range(60)) + " " + " ".join(f"v{i}" for i in range(20))
    h, times, n = dart.shingles(utf8(pa.array([a, b])))
    weight = times.astype(float) if by_count else np.ones(len(h))
    sig = dart.signatures(h, weight, n, 2000)
    x, y = ({k: w for k, w in zip(h[p].tolist(), weight[p].tolist(), strict=True)} for p in (slice(0, n[0]), slice(n[0], None)))
    keys = {*x, *y}
    want = sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.05


def test_fractional_weights_agree_as_they_should():
    h = np.arange(200, dtype=np.uint64)
    x, y = np.full(100, 0.5), np.full(100, 1.5)
    sig = dart.signatures(np.concatenate([h[:100], h[:100]]), np.concatenate([x, y]), np.array([100, 100]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.05


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(100, 200)], "a long, b long"))
    got = {r.id: r["class"] for r in dart.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


# Classifiers

def test_chunks_cover_texts_whole():
    for size in (0, 1, 511, 512, 513, 960, 961, 5000):
        chunks, n = bytecnn.chunked(np.arange(size, dtype=np.int64) % 250, np.array([0, size]))
        seen = np.zeros(size + bytecnn.CHUNK * 2, bool)
        for c in range(n[0]):
            seen[c * (bytecnn.CHUNK - bytecnn.OVERLAP) :][: bytecnn.CHUNK] = True
        assert seen[:size].all() and n[0] >= 1 and (chunks != bytecnn.PAD).sum() >= size


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = bytecnn.fit([], np.empty(0), 0.5)
    net.last = rng.normal(size=2 * bytecnn.FILTERS)
    chunks, n, y = rng.integers(0, 256, (5, bytecnn.CHUNK)).astype(np.int16), np.array([2, 3]), np.array([1.0, 0.0])

    def loss():
        h = bytecnn.chunk_features(net.tables().astype(float), net.bias, chunks).astype(float)
        p = bytecnn.sigmoid(bytecnn.document_features(h, n) @ net.last + net.intercept)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    grads = bytecnn._step(net, chunks, n, y)
    for name, i, at in (("last", 3, (2,)), ("bias", 2, (1,)), ("filters", 1, (5, 4))):
        p, eps = getattr(net, name), 1e-2
        p[at] += eps
        up = loss()
        p[at] -= 2 * eps
        down = loss()
        p[at] += eps
        assert abs((up - down) / (2 * eps) - grads[i][at]) < 2e-2 * max(1, abs(grads[i][at]))


def test_network_learns_and_takes_odd_rows(spark, odd, none):
    labelled = spark.createDataFrame([(i, ("Some calm words of prose, " if i % 3 else "!!@@ ##$$ %%^^ ") * (1 + i % 40), int(i % 3 > 0)) for i in range(400)], "doc_id long, text string, label int")
    labels = labelled.select(F.col("doc_id").alias("id"), "label")
    net = bytecnn.train(labelled, labels, rows_per_label=100)
    got = labelled.select("label", bytecnn.score(F.col("text"), net).alias("p")).collect()
    assert np.mean([(r.p >= 0.5) == r.label for r in got]) > 0.97
    scores = [r.p for r in odd.select(bytecnn.score(F.col("text"), net).alias("p")).collect()]
    assert len(scores) == odd.count() and all(0 <= p <= 1 for p in scores)
    assert none.select(bytecnn.score(F.col("text"), net).alias("p")).collect() == []
    alone = bytecnn.train(labelled, labels.filter("label = 1"))
    assert odd.select(bytecnn.score(F.col("text"), alone).alias("p")).distinct().count() == 1
    empty = bytecnn.train(labelled, labels.limit(0))
    assert odd.select(bytecnn.score(F.col("text"), empty).alias("p")).first().p == pytest.approx(0.5)


def test_training_sees_every_chunk_of_a_sampled_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, chr(97 + i) * size) for i, size in enumerate((20000, 9001, 10, 448 * 8 + 65))], "doc_id long, text string")
    bags = []
    monkeypatch.setattr(bytecnn, "fit", lambda texts, labels, share: bags.extend(texts))
    bytecnn.train(docs, docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 2).alias("label")))
    assert {int(b[0]) - 97: len(b) for b in bags} == dict(enumerate((20000, 9001, 10, 448 * 8 + 65)))


def test_training_texts_are_bounded_in_bytes_and_never_cut(spark, monkeypatch):
    docs = spark.createDataFrame([(i, chr(97 + i % 26) * size) for i, size in enumerate([3000] * 30 + [90000, 200000, 0])], "doc_id long, text string")
    bags = []
    monkeypatch.setattr(bytecnn, "fit", lambda texts, labels, share: bags.extend(texts))
    bytecnn.train(docs, docs.select(F.col("doc_id").alias("id"), F.lit(1).alias("label")), bytes_per_label=30000)
    assert 25000 < sum(map(len, bags)) <= 30000 and set(map(len, bags)) <= {0, 3000}


def test_a_long_text_in_steps_has_the_features_of_the_whole():
    net = bytecnn.fit([], np.empty(0), 0.5)
    for size in (0, 1, 600, 448 * 5000 + 700):
        text = np.random.default_rng(size).integers(0, 256, size).astype(np.uint8)
        chunks, n = bytecnn.chunked(text, np.array([0, size]))
        whole = bytecnn.document_features(bytecnn.chunk_features(net.tables(), net.bias, chunks), n)
        assert np.allclose(bytecnn.long_features(net.tables(), net.bias, text), whole, rtol=1e-4, atol=1e-5)


@pytest.mark.parametrize("what", ["shingles", "features", "grams"])
def test_one_long_text_takes_bounded_memory(what):
    """Working memory beyond the text, numpy's own count, for 20 MB in one text."""
    text = (b"Some words of a long text, again and anew. " * 500_000)[: 20 << 20]
    flat, net = np.frombuffer(text, np.uint8), bytecnn.fit([], np.empty(0), 0.5)
    arrow = utf8(pa.array([text.decode()], pa.large_string()))
    run = {"shingles": lambda: dart.shingles(arrow), "grams": lambda: centroid.gram_counts(arrow),
           "features": lambda: bytecnn.chunked(flat[: bytecnn.CHUNKS_CUT * 448], np.array([0, bytecnn.CHUNKS_CUT * 448]))}[what]
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < {"shingles": 16, "grams": 8, "features": 8}[what] * len(text)


def test_filters_meet_a_pattern_at_every_offset():
    net = bytecnn.fit([], np.empty(0), 0.5)
    texts = [np.frombuffer(b"a" * at + b"PATTERN!" + b"a" * (300 - at), np.uint8) for at in (40, 41)]
    x, y = (bytecnn.chunk_features(net.tables(), net.bias, bytecnn.chunked(t, np.array([0, len(t)]))[0]) for t in texts)
    assert (x == y).all()


def test_gram_counts_are_of_whole_texts(monkeypatch):
    texts = ["abcabc", "", "x", "Été déjà", "ab" * 3000]
    whole = centroid.gram_counts(utf8(pa.array(texts)))
    monkeypatch.setattr(centroid, "POSITIONS_AT_ONCE", 7)
    assert (centroid.gram_counts(utf8(pa.array(texts))) == whole).all()
    sizes = [len(t.lower().encode()) for t in texts]
    assert whole.sum(axis=1).tolist() == [max(0, s - 1) + max(0, s - 2) for s in sizes]


def test_languages_on_held_out_rows(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = centroid.train(docs.filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    got = docs.filter("crc32(cast(doc_id as string)) % 5 = 0 and lang is not null").select("lang", centroid.predict(F.col("text"), model).alias("f")).collect()
    assert np.mean([r.lang == r.f.lang for r in got]) > 0.95
    rows = odd.select("doc_id", "text", centroid.predict(F.col("text"), model).alias("f")).collect()
    for r in rows:
        assert (r.f.lang == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and 0 <= r.f.score <= 1
    assert none.select(centroid.predict(F.col("text"), model).alias("f")).collect() == []
    untaught = centroid.train(docs.limit(0))
    assert odd.select(centroid.predict(F.col("text"), untaught)["lang"].alias("l")).distinct().collect()[0].l == "und"
    far = spark.createDataFrame([("zqxj vwkq " * 50,)], "text string").select(centroid.predict(F.col("text"), model).alias("f")).first()
    assert far.f.rejected and far.f.lang in model.language


# The pipeline

def test_stages_take_effect_on_all_their_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    good = corpus_pipeline.materialise(corpus_pipeline.keep_quality(spark, docs, SF), "t")
    assert good.columns == columns and 0.5 * docs.count() < good.count() <= docs.count()
    single = corpus_pipeline.materialise(corpus_pipeline.drop_near_copies(spark, good, SF), "t")
    classes = brute_classes([(r.doc_id, r.text) for r in good.collect()])
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values()))
    clean = corpus_pipeline.materialise(corpus_pipeline.mask_personal_data(spark, single, SF), "t")
    assert clean.columns == columns and clean.count() == single.count() and not any(base_spans(r.text) for r in clean.collect())
    mixed = corpus_pipeline.materialise(corpus_pipeline.mix_sources(spark, clean, SF), "t")
    assert mixed.columns == columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    last = corpus_pipeline.encode_texts(spark, mixed, SF)
    assert last.count() == mixed.count() and last.filter("n_tokens <> size(ids)").count() == 0
    assert corpus_pipeline.run(spark, SF).columns == last.columns and len(corpus_pipeline.STAGES) == 5


def test_near_copy_stage_keeps_one_row_of_an_id(spark, odd):
    kept = corpus_pipeline.drop_near_copies(spark, odd, SF)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == odd.columns and ids[4] == 1 and 5 not in ids and ids[None] == 1 and ids[0] == ids[1] == 1


def test_a_sieve_lets_every_key_through(spark):
    from riskspark.llm.text import sieve, sifted
    keys = spark.range(3000).select((F.col("id") * 7 - 5000).alias("k"))
    marked = sifted(spark.range(-20000, 20000).withColumnRenamed("id", "v"), F.col("v"), sieve(keys, "k"))
    found = marked.filter("__may")
    assert marked.columns == ["v", "__may"] and marked.count() == 40000
    assert found.join(keys, F.col("v") == F.col("k"), "left_semi").count() == 3000 and found.count() < 3100
    assert sifted(keys, F.col("k"), sieve(keys.limit(0), "k")).filter("__may").count() == 0
