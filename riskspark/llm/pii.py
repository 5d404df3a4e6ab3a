"""Personal data by weak supervision, in DataFrame operations only.

Base spans are what fixed patterns and their checks accept; they always stay. Candidates are the base spans, what
the patterns match but the checks refuse (of seven digits or more), and what wider patterns match: written-out
addresses, telephone numbers without a plus, numbers in the form of social security numbers. Labelers vote on
each candidate for (1) or against (-1) or abstain (0): the patterns' checks, gazetteers of address endings, card
issuers and units, and the words around. Candidates with equal votes are counted together; expectation
maximisation over these counts estimates how reliable each labeler is (the chance of each vote for personal and
for other candidates) and so how likely each candidate is personal. With these soft labels a naive Bayes
classifier over a candidate's form and surroundings is trained; candidates it accepts that touch no base span are
added.

The counts and the classifier's table have as many rows as there are vote patterns and feature values, whatever
the input; all documents are counted. Positions are code points, ends exclusive. NULL texts count as empty. Empty
tables give empty results; without candidates no span is added. Repeated rows get equal spans. Further columns
pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import discard, materialise

KINDS = ("email", "ip", "card", "phone", "ssn")
#: The contract's patterns. Quantifiers that never give back and looks at the character before keep the same
#: matches and make a long run of one class linear.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Text that any match of a pattern holds: the rest is not searched.
NEEDS = {"email": "@", "phone": "+"}
WIDER = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?[(\[{]at[)\]}] ?[a-z0-9-]{1,63}+(?: ?(?:\.|[(\[{]dot[)\]}]) ?[a-z0-9-]{1,63}+){1,6}+",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9A-Za-z+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Gazetteers and context words.
ENDINGS = r"(?i)\b(?:com|org|net|edu|gov|info|io|eu|uk|de|fr|es|at|ch|it|nl)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
UNITS = r"(?i)^ ?(?:kg|km|cm|mm|eur|usd|euro|dollars?|percent|%|pages?|seiten|euros|francs)"
FOR_WORDS = r"(?i)\b(?:phone|tel|telefon|t[ée]l[ée]phone|call|mobile|fax|contact|kontakt|contacto|e-?mail|mail|correo|ssn|social|card|visa|mastercard|karte|carte|tarjeta|ip|address|adresse|direcci[óo]n)\b"
AGAINST_WORDS = r"(?i)\b(?:isbn|issn|doi|version|v|order|invoice|figure|table|page|no|nr|article|section|rfc|build|serial|sku|item)\b[.:# ]*$"
AROUND = 40
ROUNDS = 25
LABELERS = 6
#: Candidates of fewer digits are too common to be of interest.
LEAST_DIGITS = 7


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, n - i + 1, F.lit(1)).cast("int") * (1 + (i - 1) % 2)
        return total + F.when(x > 9, x - 9).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _passes(kind: str, x: Column) -> Column:
    """Does a match of the kind's base pattern pass its check?"""
    if kind == "ip":
        short = lambda p: F.ltrim(p, F.lit("0"))
        small = lambda p: (F.length(short(p)) <= 3) & (F.lpad(short(p), 3, "0") <= "255")
        return F.forall(F.split(x, r"\."), small)
    if kind == "card":
        d = _digits(x)
        return F.length(d).between(12, 19) & _luhn(F.substring(d, 1, 19))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, kind: str, needs: str | None, base: bool) -> Column:
    """array of (start, end, kind number, value, ok) of the matches of interest, in order."""
    row = "struct<start: int, end: int, kind: int, value: string, ok: boolean>"
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def add(state: Column, x: Column) -> Column:
        value = x["1"]
        start = state["at"] + F.length(x["0"])
        end = start + F.length(value)
        ok = _passes(kind, value) if base else F.lit(False)
        wanted = (ok | (F.length(_digits(value)) >= LEAST_DIGITS)) if base else F.lit(True)
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), value.alias("value"), ok.alias("ok"))
        more = F.concat(state["out"], F.array(span))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(value.isNotNull() & wanted, more).otherwise(state["out"]).alias("out"))

    nothing = F.expr(f"cast(array() as array<{row}>)")
    found = F.aggregate(F.arrays_zip(gaps, hits), F.struct(F.lit(0).alias("at"), nothing.alias("out")), add)["out"]
    possible = F.contains(text, F.lit(needs)) if needs else text.rlike(pattern)
    return F.when(possible, found).otherwise(nothing)


def _candidate(text: Column, base: Column) -> Callable[[Column], Column]:
    def of(c: Column) -> Column:
        before = F.substring(text, F.greatest(c["start"] - AROUND + 1, F.lit(1)), F.least(c["start"], F.lit(AROUND)))
        after = F.substring(text, c["end"] + 1, F.lit(AROUND))
        kind, d = c["kind"], _digits(c["value"])
        email, ip, card, phone, ssn = (kind == i for i in range(5))
        sign = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
        cue, against = before.rlike(FOR_WORDS), before.rlike(AGAINST_WORDS)
        neighbours = F.exists(base, lambda b: (b["start"] != c["start"]) & (F.abs(b["start"] - c["end"]) < 5 * AROUND))
        groups = F.regexp_count(c["value"], F.lit("[0-9]+"))
        votes = F.array(
            sign(c["ok"], ip | card | phone & F.contains(c["value"], F.lit("+"))),
            sign(email & c["value"].rlike(ENDINGS) | card & d.rlike(ISSUERS) & F.length(d).between(13, 19), card & (F.length(d) < 12)),
            sign(F.lit(False), after.rlike(UNITS)),
            sign(cue & ~against, against),
            sign(neighbours),
            sign(email | (phone | ssn) & (groups >= 3), card & (groups > 5)))
        text_of = lambda name, x: F.concat(F.lit(f"{name}="), x.cast("string"))
        features = F.array(
            text_of("kind", kind), text_of("digits", F.least(F.length(d), F.lit(20))), text_of("groups", F.least(groups, F.lit(7))),
            text_of("ending", c["value"].rlike(ENDINGS)), text_of("unit", after.rlike(UNITS)), text_of("cue", cue), text_of("against", against),
            text_of("issuer", d.rlike(ISSUERS)), text_of("letter", before.rlike("[A-Za-z]$")), text_of("near", neighbours))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), kind.alias("kind"), c["ok"].alias("ok"), votes.alias("votes"), features.alias("features"))
    return of


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __pii: array of candidates (start, end, kind, ok, votes, features); the base spans are those `ok`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = [_spans(text, p, k, NEEDS.get(k), True) for k, p in BASE.items()] + [_spans(text, p, k, None, False) for k, p in WIDER.items()]
    found = docs.withColumn("__found", F.concat(*parts))
    base = F.filter("__found", lambda s: s["ok"])
    # A wider match that touches a base span is not a span of its own.
    kept = F.filter("__found", lambda c: c["ok"] | ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return found.withColumn("__pii", F.transform(kept, _candidate(text, base))).drop("__found")


def posteriors(candidates: DataFrame) -> DataFrame:
    """(votes, p): for each pattern of votes, the probability that a candidate is personal.

    Expectation maximisation from a majority start, folded over one row that holds the counts of all patterns, at
    most 3 ^ LABELERS of them.
    """
    counted = candidates.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    one = counted.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("rows"))
    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))
    start = F.transform("rows", lambda r: 1 / (1 + F.exp(-total(r["votes"], lambda v: v.cast("double")))))

    def round_of(p: Column, _: Column) -> Column:
        rows = F.arrays_zip(F.col("rows"), p.alias("p"))
        weights = F.transform(rows, lambda r: F.struct(r["rows"]["votes"].alias("votes"), (r["rows"]["n"] * r["p"]).alias("a"), (r["rows"]["n"] * (1 - r["p"])).alias("b")))
        all_a, all_b = total(weights, lambda w: w["a"]), total(weights, lambda w: w["b"])

        def odds(labeler: Column) -> Column:
            """Log odds of each vote, -1 to 1, of one labeler."""
            return F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda v: F.log(
                (total(weights, lambda w: F.when(F.get(w["votes"], labeler) == v, w["a"]).otherwise(0.0)) + 0.5) / (all_a + 1.5))
                - F.log((total(weights, lambda w: F.when(F.get(w["votes"], labeler) == v, w["b"]).otherwise(0.0)) + 0.5) / (all_b + 1.5)))
        table = F.transform(F.sequence(F.lit(0), F.lit(LABELERS - 1)), odds)
        # The table is bound once, as the only element of an array, and then read by every pattern.
        prior = F.log(all_a + 0.5) - F.log(all_b + 0.5)
        return F.flatten(F.transform(F.array(F.struct(table.alias("t"), prior.alias("prior"))), lambda m: F.transform("rows", lambda r: 1 / (1 + F.exp(-(
            m["prior"] + F.aggregate(F.sequence(F.lit(0), F.lit(LABELERS - 1)), F.lit(0.0), lambda a, i: a + F.get(F.get(m["t"], i), F.get(r["votes"], i) + 1))))))))

    last = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_of)
    fitted = one.select(F.explode(F.arrays_zip(F.col("rows"), last.alias("p"))).alias("x"))
    return fitted.select("x.rows.votes", "x.p")


def train(candidates: DataFrame) -> dict[str, float]:
    """The classifier: log odds of every feature value, and of all candidates under the empty name.

    `candidates` has rows of votes and features. At most some eighty numbers reach the driver.
    """
    groups = materialise(candidates.groupBy("votes", "features").agg(F.count("*").alias("n")), "pii-patterns")
    soft = posteriors(candidates).join(groups, "votes").select("features", (F.col("n") * F.col("p")).alias("a"), (F.col("n") * (1 - F.col("p"))).alias("b"))
    by_value = soft.select(F.explode("features").alias("name"), "a", "b").unionByName(soft.select(F.lit("").alias("name"), "a", "b"))
    sums = {r["name"]: (r["a"], r["b"]) for r in by_value.groupBy("name").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).orderBy("name").collect()}
    if "" not in sums:
        return {}
    all_a, all_b = sums[""]
    odds = {name: math.log((a + 0.5) / (all_a + 1)) - math.log((b + 0.5) / (all_b + 1)) for name, (a, b) in sums.items() if name}
    return odds | {"": math.log(all_a + 0.5) - math.log(all_b + 0.5)}


def accepted(model: dict[str, float], pii: str = "__pii") -> Column:
    """array of (start, end, kind): base spans and candidates the classifier accepts, by start, then kind."""
    if model:
        odds = F.create_map(*[x for k, v in sorted(model.items()) if k for x in (F.lit(k), F.lit(v))])
        likely = lambda c: F.aggregate(c["features"], F.lit(model[""]), lambda a, f: a + F.coalesce(odds[f], F.lit(0.0))) > 0
    else:
        likely = lambda c: F.lit(False)
    kept = F.filter(pii, lambda c: c["ok"] | likely(c))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))))


def base_spans(pii: str = "__pii") -> Column:
    kept = F.filter(pii, lambda c: c["ok"])
    return F.array_sort(F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))


def count_of(spans: Column | str, kind: str) -> Column:
    """How many of the spans are of one kind, as a long."""
    # The lambda takes one argument: to a second one, a default too, `filter` passes the element's place.
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every stretch of touching spans replaced by the kind of its first, in brackets."""
    row = "struct<start: int, end: int, kind: int>"

    def merge(out: Column, s: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        return F.when((F.size(out) > 0) & (s["start"] < last["end"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(joined))).otherwise(F.concat(out, F.array(fresh)))

    merged = F.aggregate(spans, F.expr(f"cast(array() as array<{row}>)"), merge)
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(parts: Column) -> Column:
        before = F.transform(parts, lambda s, i: F.concat(F.substring(text, F.coalesce(F.get(parts, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(parts, i - 1)["end"], F.lit(0))), F.get(kinds, s["kind"])))
        end = F.get(parts, F.size(parts) - 1)["end"]
        return F.concat(F.array_join(before, ""), F.substring(text, end + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.get(F.transform(F.array(merged), cut), F.lit(0))).otherwise(text)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of start, kind, end) of every row."""
    found = with_candidates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "__pii")
    found = materialise(found, "pii-candidates")
    model = train(found.select(F.explode("__pii").alias("c")).select("c.votes", "c.features"))
    return found.select("doc_id", base_spans().alias("base"), accepted(model).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with all spans masked in their text. The texts are searched twice instead of being kept."""
    seen = with_candidates(docs, text_col)
    # Written before it is exploded: in one projection Spark would search anew for every part of the result.
    found = materialise(seen.select("__pii"), "pii-candidates")
    model = train(found.select(F.explode("__pii").alias("c")).select("c.votes", "c.features"))
    discard(found)
    return seen.withColumn(text_col, masked(F.col(text_col), accepted(model))).select(*docs.columns)
