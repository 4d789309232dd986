"""Language identification, phrase mining and centroid clustering."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.conftest import DOCUMENTS, awkward, prose
from tidemark.llm import centroids, phrases
from tidemark.llm import language_id as li
from tidemark.llm.bytescan import slices

FOLDER = "/root/testdata/sf0.01"


# --- language identification ---------------------------------------------------------------------


def plain_grams(text: str | None) -> Counter:
    """Runs of 1 to 3 characters of a folded text in which other characters than letters are one gap."""
    folded = re.sub(r"\0+", "\0", "".join(c if c.isalpha() else "\0" for c in (text or "").lower())).lstrip("\0")
    folded = folded if folded.endswith("\0") else folded + "\0"
    grams = Counter()
    for n in (1, 2, 3):
        for i in range(len(folded) - n + 1):
            g = folded[i : i + n]
            if g[0] != "\0" or g[-1] != "\0":
                grams[g] += 1
    return grams


def bucket_of(gram: str) -> int:
    key, two = 0, 1 << 64
    for n, c in enumerate(gram, 1):
        key = (key * 0x9E3779B97F4A7C15 + (0 if c == "\0" else ord(c)) + n) % two
    return ((key ^ (key >> 29)) * 0xBF58476D1CE4E5B9) % two >> (64 - li.BUCKET_BITS)


TEXTS = st.lists(st.none() | st.text(st.sampled_from("abC Éßİ日.9\n\x00"), max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 2, 7, 1 << 20]))
def test_grams_agree_with_plain_python(texts, segment):
    before, li.SEGMENT = li.SEGMENT, segment
    try:
        check_grams(texts)
    finally:
        li.SEGMENT = before


def check_grams(texts):
    found = [row for part in slices(pa.array(texts, pa.string())) for _, has, counts in li._grams(part) for row in zip(has, counts, strict=True)]
    assert len(found) == len(texts)
    for text, (has, counts) in zip(texts, found, strict=True):
        wanted = np.zeros(li.BUCKETS, np.int64)
        for gram, n in plain_grams(text).items():
            wanted[bucket_of(gram)] += n
        assert has == any(c.isalpha() for c in (text or "").lower())
        if has:
            assert (counts == wanted).all()


def test_language_query_on_the_documents(spark):
    found = entry.queries()["op11_language_id"](spark, FOLDER)
    rows = found.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held_out = [r for r in rows if r["held_out"]]
    assert 0.15 < len(held_out) / len(rows) < 0.35
    assert np.mean([r["lang_pred"] == r["lang"] for r in held_out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def two_languages(spark):
    rows = [(i, prose(i, 40), "xx", "a", 1) for i in range(40)] + [(100 + i, prose(i, 40).translate(str.maketrans("aeiou", "yzqwj")), "yy", "a", 1) for i in range(40)]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_model_gives_the_score_that_plain_python_gives(spark):
    model = li.train(two_languages(spark))
    text = "Serlan moti; karu 77 den"
    x = np.zeros(li.BUCKETS)
    for gram, n in plain_grams(text).items():
        x[bucket_of(gram)] += n
    x = np.log1p(x) * model.idf
    near = model.centroids @ (x / np.linalg.norm(x))
    (part,) = slices(pa.array([text]))
    names, score, _ = model.judge(part)
    assert names == [model.languages[near.argmax()]] == ["xx"]
    assert score[0] == pytest.approx(near.max(), abs=1e-5)


def test_inverse_document_frequencies_cover_all_rows(spark):
    docs = two_languages(spark)
    few, many = li.train(docs, per_language=3), li.train(docs)
    texts = [r[0] for r in docs.select("text").collect()]
    with_gram = Counter(b for t in texts for b in {bucket_of(g) for g in plain_grams(t)})
    wanted = [math.log((1 + len(texts)) / (1 + with_gram[b])) + 1 for b in range(li.BUCKETS)]
    assert np.allclose(few.idf, wanted, atol=1e-5) and (few.idf == many.idf).all()


def test_language_of_awkward_texts(spark, documents, clashing):
    model = li.train(two_languages(spark))
    found = li.identify(documents, model).collect()
    assert len(found) == len(awkward())
    by_id = {r["doc_id"]: r for r in found}
    for i in (0, 1, 2):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, False)
    assert by_id[6]["lang_pred"] in ("xx", "yy")
    own = li.identify(clashing, model)
    assert own.columns.count("score") == 1 and "kept" in own.columns
    assert sorted(map(str, own.select("doc_id", "lang_pred", "score").collect())) == sorted(str(r) for r in li.identify(documents, model).select("doc_id", "lang_pred", "score").collect())


def test_language_without_anything_to_learn(spark, documents, none):
    nothing = li.train(none)
    assert nothing.languages == []
    assert {(r["lang_pred"], r["score"]) for r in li.identify(documents, nothing).collect()} == {("und", 0.0)}
    assert li.identify(none, li.train(two_languages(spark))).collect() == []
    unlabelled = documents.withColumn("lang", F.lit(None).cast("string"))
    assert li.train(unlabelled).languages == []


def test_far_texts_are_rejected_and_reruns_agree(spark):
    docs = two_languages(spark)
    model, again = li.train(docs), li.train(docs.repartition(7))
    assert model.languages == again.languages and (model.centroids == again.centroids).all()
    odd = spark.createDataFrame([(1, "日本語の文章", None, None, 1), (2, prose(3, 40), None, None, 1)], DOCUMENTS)
    assert {r["doc_id"]: r["rejected"] for r in li.identify(odd, model).collect()} == {1: True, 2: False}


def test_one_text_in_a_third_of_all_rows_is_sampled_once(spark):
    docs = two_languages(spark)
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("ser ser ser").alias("text"), F.lit("xx").alias("lang"))
    sample = li._sample(docs.select("text", "lang").unionByName(same.select("text", "lang")), 10).collect()
    assert len(sample) == len(set(sample)) and Counter(r["lang"] for r in sample)["xx"] <= 10


# --- phrases -----------------------------------------------------------------------------------------

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, least: int, top: int | None = 2000, keep: int = 100) -> list[tuple]:
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        gone = {
            q[i:j] for q, b in candidates.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and 100 * b >= keep * candidates[q[i:j]]
        }
        best = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def mined(df, **options) -> list[tuple]:
    return sorted(tuple(r) for r in phrases.mine_phrases(df, **options).collect())


def test_phrases_of_the_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert mined(docs, least=8, top=300) == plain_phrases(rows, 8, 300)


def small_table(spark, seed: int = 0):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "é", "the", "of", "the", "of", "x\x00y", "日本"]
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ", ", "!"]) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, rnd.choice(["en", "en", "fr", None, "und"]), "s", 1) for i, t in enumerate(texts)]
    rows += [(None, None, "en", None, None), (1, "", None, None, None), (2, "of the of the of the " * 200, "en", "s", 1), (3, "the of " * 3, "en", "s", 1)]
    return spark.createDataFrame(rows + rows[:9], DOCUMENTS)


@pytest.mark.parametrize(("least", "keep", "top"), [(1, 100, None), (2, 100, 7), (3, 60, 2000)])
def test_phrases_agree_with_brute_force(spark, least, keep, top):
    docs = small_table(spark)
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert mined(docs.repartition(3), least=least, top=top, keep_percent=keep) == plain_phrases(rows, least, top, keep)


def test_hot_prefixes_are_dealt_on_and_counts_stay(spark, monkeypatch):
    docs = small_table(spark, 1)
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    monkeypatch.setattr(phrases, "HOT_SHARE", 40)
    monkeypatch.setattr(phrases, "STRIDE", 1)
    monkeypatch.setattr(phrases, "GROUP_WORDS", 64)
    monkeypatch.setattr(phrases, "FILTER_BITS", 8)  # many false hits
    monkeypatch.setattr(phrases, "TABLE_WORDS", 3)  # most words travel as fingerprints
    assert mined(docs, least=4, top=None) == plain_phrases(rows, 4, None)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=9), max_size=8), st.sets(st.integers(1, 3)))
def test_flow_out_of_nodes_counts_prefixes(pieces, starts):
    """Groups in any dealing hand on counts that add up to those of all runs of words."""
    prints = np.array([w for p in pieces for w in p], np.uint64)
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    edges = phrases.edges_of(prints, piece)
    every = np.unique(np.concatenate([phrases._prefix_prints(edges, k) for k in (2, 3, 4)]))
    hot = every[[i for i in range(len(every)) if i % 3 in starts]] if len(every) else every
    group = phrases.deal(edges, hot, 5)
    got = Counter()
    for g in range(5):
        found, n = phrases.prefix_counts(edges[group == g], np.ones((group == g).sum(), np.int64), hot, 1)
        for row, c in zip(found.tolist(), n.tolist(), strict=True):
            got[tuple(w for w in row if w)] += c
    wanted = Counter(tuple(p[i : i + k]) for p in pieces for k in range(2, 6) for i in range(len(p) - k + 1))
    assert got == wanted


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), min_size=5, max_size=5), min_size=1, max_size=9), st.sets(st.integers(0, 2**64 - 1)), st.sampled_from([1, 2**33]))
def test_packed_edges_come_back(edges, extra, most):
    edges = np.array(edges, np.uint64)
    table = np.unique(np.concatenate([np.zeros(1, np.uint64), edges[::2, 0], np.array(sorted(extra), np.uint64)]))
    n = np.arange(len(edges)) + most
    found, counts = phrases.unpack(phrases.pack(edges, n, table), table)
    assert (found == edges).all() and (counts == n).all()


def test_scores_pass_64_bits(spark):
    big = 6_000_000_000_000
    counted = spark.createDataFrame([([1, 2], big - 1)], "words array<bigint>, a bigint")
    words = spark.createDataFrame([("en", 1, big), ("en", 2, big + 7)], "lang string, print bigint, n bigint")
    totals = spark.createDataFrame([("en", 40 * big)], "lang string, n bigint")
    (row,) = phrases.scored_phrases(counted, words, totals).collect()
    assert row["score"] == 1000 * (big - 1) * 40 * big // (big * (big + 7))


def test_phrases_of_awkward_and_empty_tables(spark, documents, clashing, none):
    rows = [tuple(r) for r in documents.select("text", "lang").collect()]
    assert mined(documents, least=3) == plain_phrases(rows, 3) == mined(clashing, least=3)
    assert mined(none) == [] and mined(documents, least=10**6) == []
    assert [c for c, _ in phrases.mine_phrases(none).dtypes] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# --- centroids ---------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, cluster string"


def plain_clusters(rows, clusters=8, rounds=10, seed=3, components=64, scale=1024) -> list[tuple]:
    kept = [
        (i, [max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(scale * x))) for x in e]) for i, e in rows
        if e is not None and len(e) == components and all(x is not None and math.isfinite(x) for x in e)
    ]
    key = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    now = [e for _, e in sorted((key(i), e) for i, e in kept)[:clusters]]
    near = lambda e: min((sum((a - b) ** 2 for a, b in zip(e, c, strict=True)), j) for j, c in enumerate(now))
    for _ in range(rounds):
        members = {}
        for _, e in kept:
            members.setdefault(near(e)[1], []).append(e)
        now = [[sum(x) // len(members[j]) for x in zip(*members[j], strict=True)] if j in members else c for j, c in enumerate(now)]
    found = [(i, *near(e)[::-1]) for i, e in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found), key=str)


def clustered(df, **options) -> list[tuple]:
    return sorted((tuple(r) for r in centroids.cluster_vectors(df, **options).drop("centroid").collect()), key=str)


def vector_rows(n: int, components: int) -> list[tuple]:
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-1, 0, 1, 2]) + rnd.gauss(0, 0.2) for _ in range(components)], "x") for i in range(n)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0] * (components - 1), [1.0] * (components + 1), [nan] * components, [0.0] * (components - 1) + [inf], [None] + [0.0] * (components - 1)]
    same = [0.5] * components
    return rows + [(1000 + i, e, None) for i, e in enumerate(odd)] + [(7, same, None), (7, same, None), (None, same, None), (8, [0.0] * components, None), (9, [-0.0004] * components, None)]


@pytest.mark.parametrize(("clusters", "components", "n"), [(4, 5, 60), (1, 3, 9), (50, 2, 3)])
def test_clusters_agree_with_plain_python(spark, clusters, components, n):
    df = spark.createDataFrame(vector_rows(n, components), VECTORS)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    options = {"clusters": clusters, "rounds": 4, "components": components}
    assert clustered(df.repartition(5), **options) == plain_clusters(rows, **options)


def test_clusters_that_lose_all_vectors_keep_their_centroid(spark):
    # Two first centroids are equal, so the second one never gets a vector.
    rows = [(i, [1.0, 1.0], "x") for i in range(6)] + [(100, [9.0, -9.0], "x")]
    options = {"clusters": 6, "rounds": 3, "components": 2}
    assert clustered(spark.createDataFrame(rows, VECTORS), **options) == plain_clusters([r[:2] for r in rows], **options)


def test_large_components_are_held_and_fit(spark):
    rows = [(i, [3e38 * (-1) ** (i + j) for j in range(64)], None) for i in range(12)]
    got = clustered(spark.createDataFrame(rows, VECTORS), clusters=1)
    wanted = plain_clusters([r[:2] for r in rows], clusters=1)
    assert [r[:3] + r[5:] for r in got] == [r[:3] + r[5:] for r in wanted]
    assert got[0][2] == 64 * centroids.LARGEST**2
    assert wanted[0][4] > 1 << 63 and got[0][4] is None  # beyond a bigint


def test_no_vectors_no_clusters(spark):
    assert clustered(spark.createDataFrame([], VECTORS)) == []
    assert clustered(spark.createDataFrame([(1, None, None), (2, [float("nan")] * 64, None)], VECTORS)) == []
    assert centroids.cluster_vectors(spark.createDataFrame([], VECTORS)).columns == centroids.cluster_vectors(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), rounds=1).columns
