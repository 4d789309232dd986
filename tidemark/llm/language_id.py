"""Language identification by nearest centroid over hashed character n-grams.

A text is folded to lower case, runs of other characters than letters become one gap, and its runs of 1 to
LONGEST characters that begin or end with a letter are counted in BUCKETS hash buckets. The vector of a text is
log(1 + count) * idf, brought to length 1. Each language has a few centroids, found by clustering the
vectors of a sample of its texts; a text gets the language of the centroid with the largest cosine. A text
farther from it than nearly all of its sample (share REJECT_BEYOND) is marked as rejected.

Numbers of texts and inverse document frequencies cover all training rows. The vectors that are clustered on the
driver are those of at most SAMPLE_TEXTS distinct texts of each language, chosen by a hash of the text, and the model
holds CENTROIDS vectors of BUCKETS floats for a language; more than MOST_LANGUAGES languages raise.

Defined cases: a null text, or one without letters, is `und` with score 0 and not rejected; so is every text if no
training row has a language and a letter; rows with a null id are training rows like others; repeated texts of
a language are sampled once; an empty table gives no rows; extra columns are kept, and one named like an added
column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import Texts, slices

UNKNOWN = "und"
LONGEST, BUCKET_BITS = 3, 14
BUCKETS = 1 << BUCKET_BITS
SAMPLE_TEXTS, CENTROIDS, ROUNDS = 400, 3, 12
REJECT_BEYOND = 0.995  # of the sample of a centroid lies nearer
MOST_LANGUAGES = 500
BLOCK_TEXTS = 32  # texts whose dense counts are held at once
SEGMENT = 1 << 20  # characters whose runs are hashed at once
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: Texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, has letters, counts by text and bucket) of blocks of texts."""
    letters = _letters()
    for first in range(0, len(texts), BLOCK_TEXTS):
        last = min(first + BLOCK_TEXTS, len(texts))
        # The byte after a text is a line feed, so texts do not touch.
        data = texts.data[texts.begin[first] : texts.end[last - 1] + 1].tobytes()
        lines = data.decode("utf-8")
        points = np.frombuffer(lines.lower().encode("utf-32-le"), np.uint32)
        letter = letters[points]
        if lines.isascii():
            stop = texts.end[first:last] - texts.begin[first]
        else:  # folding may change the number of characters, so ends are counted text by text
            begin, end = texts.begin[first:last] - texts.begin[first], texts.end[first:last] - texts.begin[first]
            size = [len(data[b:e].decode("utf-8").lower()) + 1 for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
            stop = np.cumsum(size) - 1
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # a letter, or the first of a gap
        owner = np.searchsorted(stop, np.flatnonzero(keep))
        code, is_letter = np.where(letter, points, 0)[keep].astype(np.uint64), letter[keep]
        counts = np.zeros((last - first) * BUCKETS, np.int64)
        for lo in range(0, len(code), SEGMENT):  # runs that begin in a segment
            own, part, inner = (x[lo : lo + SEGMENT + LONGEST - 1] for x in (owner, code, is_letter))
            key = np.zeros(len(part), np.uint64)
            for n in range(1, LONGEST + 1):
                size = min(len(part) - n + 1, SEGMENT)
                if size <= 0:
                    break
                with np.errstate(over="ignore"):
                    key = key[:size] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 : n - 1 + size] + np.uint64(n)
                last_own, last_inner = own[n - 1 : n - 1 + size], inner[n - 1 : n - 1 + size]
                whole = (own[:size] == last_own) & (inner[:size] | last_inner)
                mixed = key[whole]
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
                counts += np.bincount(last_own[whole] * BUCKETS + bucket, minlength=len(counts))
        yield first, np.bincount(owner[is_letter], minlength=last - first) > 0, counts.reshape(last - first, BUCKETS)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.float32(1e-30))


@dataclass
class LanguageModel:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    radius: np.ndarray  # largest accepted 1 - cosine of each centroid

    def judge(self, texts: Texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        names, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.languages:
            return names, score, rejected
        for first, has_letters, counts in _grams(texts):
            near = _vectors(counts, self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            cosine = np.clip(near[np.arange(len(best)), best].astype(np.float64), 0, 1)
            rows = np.flatnonzero(has_letters)
            score[first + rows] = cosine[rows]
            rejected[first + rows] = (1 - cosine > self.radius[best])[rows]
            for r in rows.tolist():
                names[first + r] = self.languages[best[r]]
        return names, score, rejected


def _document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """(texts that have each bucket, texts with letters) of all training rows."""

    def work(batches):
        total, texts_seen = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for texts in slices(field(b, "text")):
                for _, has_letters, counts in _grams(texts):
                    total += (counts > 0).sum(axis=0)
                    texts_seen += int(has_letters.sum())
        some = np.flatnonzero(total)
        columns = [np.append(some, -1), np.append(total[some], texts_seen)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["bucket", "n"])

    rows = map_batches(training.select("text"), "bucket bigint, n bigint", work).groupBy("bucket").agg(F.sum("n")).collect()
    found = {r[0]: r[1] for r in rows}
    return np.array([found.get(i, 0) for i in range(BUCKETS)], np.int64), found.get(-1, 0)


def _sample(training: DataFrame, per_language: int) -> DataFrame:
    """(lang, text): distinct texts of each language with the smallest hashes."""
    known = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    hashed = training.withColumn("_h", F.xxhash64("text"))
    # A hash below a bound leaves about twice the wanted number before anything is sorted.
    every = F.element_at(F.create_map(*[F.lit(v) for r in known for v in (r["lang"], max(1, r["n"] // (2 * per_language)))]), F.col("lang"))
    few = hashed.where(F.pmod("_h", every) == 0) if known else hashed
    order = Window.partitionBy("lang").orderBy("_h", "text")
    ranked = few.select("lang", "text", "_h").distinct().withColumn("_at", F.row_number().over(order))
    return ranked.where(F.col("_at") <= per_language).select("lang", "text")


def _clustered(x: np.ndarray, centroids: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit centroids, cluster of each row), by cosine; the first one is the mean, others the farthest rows."""
    own = x.mean(axis=0, keepdims=True)
    own /= np.maximum(np.linalg.norm(own), 1e-30)
    while len(own) < min(centroids, len(x)):
        own = np.vstack([own, x[(x @ own.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        nearest = (x @ own.T).argmax(axis=1)
        sums = np.vstack([x[nearest == c].sum(axis=0) if (nearest == c).any() else own[c] for c in range(len(own))])
        own = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-30)
    return own, (x @ own.T).argmax(axis=1)


def train(documents: DataFrame, per_language: int = SAMPLE_TEXTS, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit on the rows of `documents` (text, lang) that have both; leave held-out rows out before."""
    training = documents.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    with_bucket, texts_seen = _document_frequencies(training)
    idf = np.log((1 + texts_seen) / (1 + with_bucket)).astype(np.float32) + 1

    def work(batches):
        for b in batches:
            for texts in slices(field(b, "text")):
                for first, has_letters, counts in _grams(texts):
                    rows = np.flatnonzero(has_letters)
                    at = pa.array(texts.first + first + rows)
                    sparse = [np.flatnonzero(counts[r]) for r in rows]
                    columns = [field(b, "lang").take(at), pa.array([s.astype("<i4").tobytes() for s in sparse], pa.binary())]
                    columns.append(pa.array([counts[r, s].astype("<i4").tobytes() for r, s in zip(rows, sparse, strict=True)], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "buckets", "counts"])

    sampled = map_batches(_sample(training, per_language), "lang string, buckets binary, counts binary", work).collect()
    by_language: dict[str, list[tuple[bytes, bytes]]] = {}
    for lang, buckets, counts in sampled:
        by_language.setdefault(lang, []).append((bytes(buckets), bytes(counts)))
    names, rows, radius = [], [np.empty((0, BUCKETS), np.float32)], []
    for lang, texts in sorted(by_language.items()):
        counts = np.zeros((len(texts), BUCKETS), np.int32)
        for i, (at, n) in enumerate(sorted(texts)):  # the order of rows must not matter
            counts[i, np.frombuffer(at, "<i4")] = np.frombuffer(n, "<i4")
        x = _vectors(counts, idf)
        own, nearest = _clustered(x, centroids, ROUNDS)
        distance = 1 - (x * own[nearest]).sum(axis=1)
        names += [lang] * len(own)
        rows.append(own.astype(np.float32))
        radius += [float(np.quantile(distance[nearest == c], REJECT_BEYOND)) if (nearest == c).any() else 0.0 for c in range(len(own))]
    return LanguageModel(names, idf, np.concatenate(rows), np.array(radius))


ADDED = {"lang_pred": "string", "score": "double", "rejected": "boolean"}


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Add lang_pred, score (the cosine) and rejected (too far from any centroid to be trusted)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # MOST_LANGUAGES bounds its size
    kept = [f for f in documents.schema if f.name not in ADDED]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in ADDED.items()])

    def work(batches):
        for b in batches:
            names, score, rejected = [], [], []
            for texts in slices(field(b, "text")):
                own, cosine, far = shared.value.judge(texts)
                names += own
                score.append(cosine)
                rejected.append(far)
            added = [pa.array(names, pa.string()), pa.array(np.concatenate([np.empty(0), *score])), pa.array(np.concatenate([np.empty(0, bool), *rejected]))]
            yield pa.RecordBatch.from_arrays([*[field(b, f.name) for f in kept], *added], [*[f.name for f in kept], *ADDED])

    return map_batches(documents, schema, work)
