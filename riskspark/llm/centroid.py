"""Language of a text by the nearest of several centroids per language.

A text is the vector of its hashed byte bigrams and trigrams (of the lower-cased UTF-8), weighted by TF-IDF and
scaled to length one. The training texts of each language are clustered by spherical k-means into CENTROIDS
centroids; a text gets the language of the centroid with the largest cosine. Its distance (1 - cosine) is
compared with those of the centroid's own training texts: a text further away than nearly all of them, by a
margin, is rejected - the flag `rejected` says so beside the language.

Training uses a bounded sample: at most SAMPLE_ROWS texts in all, equally many of each language, those with the
smallest hash of the id; texts are whole, and those without a letter teach nothing. A language is any non-null label. Without training rows every text is `und`.
Texts that are NULL or hold no letter are `und` with score 0. Ties go to the language first by code point.
Repeated rows get equal results; empty tables give empty ones. Further columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.text import bounded_sample, pieces, raw, utf8

FEATURES = 4096
#: The bound of the training sample.
SAMPLE_ROWS = 4000
CENTROIDS, ROUNDS = 4, 10
#: A distance is too large beyond this quantile of the centroid's own texts, times the margin.
QUANTILE, MARGIN = 0.99, 1.25
POSITIONS_AT_ONCE = 1 << 20
UNKNOWN = "und"


@dataclass
class Centroids:
    idf: np.ndarray
    centres: np.ndarray
    language: list[str]
    reach: np.ndarray


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Texts by hashed features, how often each occurs in the whole text."""
    flat, starts = raw(pc.utf8_lower(texts))
    out = np.zeros(len(texts) * FEATURES, np.float32)
    for a in range(0, len(flat), POSITIONS_AT_ONCE):
        # Working arrays are those of one window; the last grams of a window look two bytes further.
        stop = min(a + POSITIONS_AT_ONCE + 2, len(flat))
        part = flat[a:stop].astype(np.uint32)
        text = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(np.clip(starts, a, stop)))
        for n in (2, 3):
            end = min(POSITIONS_AT_ONCE, len(part) - n + 1)
            if end <= 0:
                continue
            code = np.full(end, n, np.uint32)
            for k in range(n):
                code = code * np.uint32(257) + part[k : end + k]
            slot = (code * np.uint32(2654435761)) >> np.uint32(20)
            whole = text[:end] == text[n - 1 : end + n - 1]
            low = text[0] * FEATURES
            own = np.bincount((text[:end] * FEATURES + slot)[whole] - low)
            out[low : low + len(own)] += own
    return out.reshape(len(texts), FEATURES)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _clusters(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[near == c].sum(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centres


def fit(counts: np.ndarray, languages: list[str], seed: int = 3) -> Centroids:
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    rng, centres, names, reach = np.random.default_rng(seed), [], [], []
    labels = np.array(languages)
    for name in sorted(set(languages)):
        x = weighted(counts[labels == name], idf)
        own = _clusters(x, CENTROIDS, rng)
        near = x @ own.T
        for c in range(len(own)):
            mine = 1 - near[near.argmax(axis=1) == c, c]
            reach.append(min(1.0, MARGIN * float(np.quantile(mine, QUANTILE))) if len(mine) else 1.0)
        centres.append(own)
        names += [name] * len(own)
    return Centroids(idf, np.concatenate(centres) if centres else np.empty((0, FEATURES), np.float32), names, np.array(reach))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Centroids:
    """Learn from the documents with a language; what reaches the driver is bounded by the sample."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("group"))
    n = rows.filter("group is not null").select("group").distinct().count()
    drawn = bounded_sample(docs, rows, max(1, sample_rows // max(1, n)), id_col, text_col).filter(F.col("text").rlike(r"\p{L}"))

    @F.arrow_udf("binary")
    def counted(batch: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for part in pieces(utf8(batch), POSITIONS_AT_ONCE, 512) for x in gram_counts(part)], pa.binary())

    got = drawn.select("group", "id", counted("text").alias("counts")).orderBy("group", "id").toArrow()
    counts = np.frombuffer(b"".join(got.column("counts").to_pylist()), np.float32).reshape(-1, FEATURES)
    return fit(counts, got.column("group").to_pylist())


def predict(text: Column, model: Centroids) -> Column:
    """Struct of lang, score (cosine, 0 to 1) and rejected."""
    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array(model.language, object)
        for batch in batches:
            near = [np.empty((0, len(names)), np.float32)]
            near += [weighted(gram_counts(part), model.idf) @ model.centres.T for part in pieces(utf8(batch), POSITIONS_AT_ONCE, 512)]
            cosine = np.concatenate(near)
            best = cosine.argmax(axis=1)
            top = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(top), pa.array(1 - top > model.reach[best])], ["lang", "score", "rejected"])

    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.language:
        return unknown
    return F.when(F.coalesce(text, F.lit("")).rlike(r"\p{L}"), run(text)).otherwise(unknown)
