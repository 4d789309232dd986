"""Connected components, running totals, PartEnum, and the vector graph, against brute force."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import compare
from tests.llm.conftest import awkward, prose
from tidemark.llm import bytescan
from tidemark.llm import partenum as pe
from tidemark.llm import vector_graph as vg
from tidemark.llm.components import connected_components
from tidemark.llm.ordering import running_totals

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest_reachable(nodes, links):
    """Smallest node that links reach, for every node."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_paths_hubs_and_loops(spark):
    rnd = random.Random(4)
    pairs = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (90, 80), (80, 90), (90, 80)]
    pairs += [(rnd.randint(200, 300), rnd.randint(200, 300)) for _ in range(60)]
    rnd.shuffle(pairs)
    edges = spark.createDataFrame([*pairs, (None, 5), (5, None)], "x bigint, y bigint")
    got = {r["node"]: r["component"] for r in connected_components(edges, "x", "y").collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert got == smallest_reachable({n for p in real for n in p}, real)
    words = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "x string, y string")
    assert {tuple(r) for r in connected_components(words, "x", "y").collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert connected_components(edges.where("false"), "x", "y").count() == 0


def test_running_totals_with_and_without_groups(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "b", "c"]), i, rnd.randint(0, 9) if i % 7 else None) for i in range(500)] + [("a", 1000 + i, 1) for i in range(300)]
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    for order, group in ((["k"], None), (["g", "k"], "g")):
        got = {r["k"]: r["before_v"] for r in running_totals(table, order, ["v"], group).collect()}
        want, held = {}, {}
        for g, k, v in sorted(rows, key=lambda r: (r[0], r[1]) if group else r[1]):
            key = g if group else 0
            want[k] = held.get(key, 0)
            held[key] = held.get(key, 0) + (v or 0)
        assert got == want
    assert running_totals(table.where("false"), ["k"], ["v"]).count() == 0


def shingles(text, n):
    words = pe_words(text)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def pe_words(text):
    return [w for w in (text or "").translate(ASCII).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]


def linked(texts, n, percent):
    """(index pairs that link, sets) by comparing all pairs."""
    sets = [shingles(t, n) for t in texts]
    found = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                found.append((i, j))
    return found, sets


def variants(seed: int, words: int, n: int, most: int) -> list[str]:
    """Copies of a text with up to `most` words changed, dropped or added."""
    rnd = random.Random(seed)
    base = prose(seed, words).split(" ")
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, most)):
            at = rnd.randrange(len(own))
            own[at : at + 1] = rnd.choice([[f"new{rnd.random()}"], [], [own[at], f"add{rnd.random()}"]])
            own = own or ["x"]
        out.append(" ".join(own))
    return out


def families() -> list[str]:
    texts = [t for _, t, *_ in awkward()]
    for k, (words, n, most) in enumerate([(6, 6, 1), (9, 10, 2), (14, 12, 2), (25, 15, 3), (40, 25, 5), (90, 40, 9), (180, 60, 20), (700, 12, 60)]):
        texts += variants(70 + k, words, n, most)
    shared = prose(500, 60)
    return texts + [f"{prose(600 + i, 15)} {shared}" for i in range(40)] + [f"{shared} {prose(700 + i, 60)}" for i in range(30)]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (3, 60)])
def test_jaccard_groups_against_all_pairs(spark, n, percent):
    texts = families()
    found, sets = linked(texts, n, percent)
    label = smallest_reachable(range(len(texts)), found)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("class", F.lit("own")).repartition(3)
    got = {r["doc_id"]: r for r in pe.near_duplicates(table, n, percent).collect()}
    assert len(got) == len(texts)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r["component_id"] for i, r in got.items()} == label


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([60, 80, 85, 95]))
def test_every_similar_pair_shares_a_signature(size, seed, percent):
    """The guarantee itself, on pairs at the very limit of the allowed differences."""
    rnd = np.random.default_rng(seed)
    base = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
    k = (100 - percent) * 2 * len(base) // (100 + percent)
    dropped = rnd.permutation(len(base))[: k // 2]
    other = np.unique(np.concatenate([np.delete(base, dropped), rnd.integers(0, 1 << 63, k - k // 2, dtype=np.uint64)]))
    common = len(np.intersect1d(base, other))
    if not len(other) or 100 * common < percent * (len(base) + len(other) - common) or np.array_equal(base, other):
        return
    found, owner = np.concatenate([base, other]), np.repeat([0, 1], [len(base), len(other)])
    size_, print_ = pe.fingerprints(found, owner, 2)
    sigs, of = pe.signatures(found, owner, size_, np.array([True, True]), percent)
    assert print_[0] != print_[1] and set(sigs[of == 0]) & set(sigs[of == 1])
    bits = np.bitwise_count(np.bitwise_xor(*pe.sketches(found, owner, 2).view(np.uint64))).sum()
    assert bits * (100 + percent) <= (len(base) + len(other)) * (100 - percent)


def test_one_document_of_each_group_stays(spark, documents, clashing, none):
    kept = pe.keep_one(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    texts = [t for _, t, *_ in awkward()]
    ids = [i for i, *_ in awkward()]
    found, sets = linked(texts, pe.WORDS, pe.PERCENT)
    label = smallest_reachable(range(len(texts)), found)
    groups = {}
    for i, g in label.items():
        groups.setdefault(g, []).append(i)
    assert len(rows) == sum(1 if sets[g] else len(m) for g, m in groups.items())
    least = sorted(min((ids[i] for i in m if ids[i] is not None), default=-99) for g, m in groups.items() if sets[g])
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -99 for r in rows if shingles(r["text"], 5)) == least
    assert pe.keep_one(none).count() == 0 and pe.near_duplicates(none).count() == 0


def test_an_id_of_nothing_but_nulls(spark):
    table = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, "q r s t u v")], "doc_id bigint, text string")
    rows = [tuple(r) for r in pe.near_duplicates(table).collect()]
    assert sorted(rows, key=str) == [(4, 2, 4), (None, 0, None), (None, 2, None), (None, 2, None)]
    assert pe.keep_one(table).count() == 3


def unlike_with_common_passage(seed: int, documents: int) -> list[tuple]:
    """Texts of their own words around one common passage, with a near copy for every fourth one."""
    rnd = random.Random(seed)
    passage = prose(1, 60)
    rows = []
    for i in range(documents):
        own = prose(1000 + i, rnd.randint(6, 25))
        rows.append((i, f"{own} {passage}"))
        if i % 4 == 0:
            rows.append((10_000 + i, f"{own} {passage} more"))
    return rows


@pytest.mark.parametrize("large", [1, 10**6])
def test_large_buckets_of_unlike_sets(spark, monkeypatch, large):
    monkeypatch.setattr(pe, "LARGE_BUCKET", large)
    rows = unlike_with_common_passage(3, 150)
    found, _ = linked([t for _, t in rows], 4, 90)
    label = smallest_reachable(range(len(rows)), found)
    want = {rows[i][0]: min(rows[j][0] for j in label if label[j] == label[i]) for i in label}
    got = {r["doc_id"]: r["component_id"] for r in pe.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), n=4, percent=90).collect()}
    assert got == want


def test_second_signatures_lose_no_similar_pair():
    rnd = random.Random(9)
    for size in (8, 30, 90, 150, 400):
        base = [f"w{rnd.randint(0, 10**9)}" for _ in range(size + 3)]
        other = list(base)
        for _ in range(max(0, size // 60)):
            other[rnd.randrange(len(other))] = "changed"
        texts = pa.array([" ".join(base), " ".join(other)])
        (part,) = bytescan.slices(texts)
        found, owner = pe.sets_of(part, 4)
        x, y = (set(found[owner == i].tolist()) for i in (0, 1))
        if 100 * len(x & y) < 85 * len(x | y):
            continue
        sizes = np.bincount(owner, minlength=2)
        for seed in (0, 1):
            sig, of = pe.signatures(found, owner, sizes, np.ones(2, bool), 85, seed=seed)
            assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist()), (size, seed)
        one, two = (set(pe.signatures(found, owner, sizes, np.ones(2, bool), 85, seed=s)[0].tolist()) for s in (0, 1))
        assert not one & two or size < 20


def vectors(seed: int) -> list[tuple]:
    rnd = np.random.default_rng(seed)
    rows, at = [], 0
    for size, noise in [(1, 0), (5, 0.03), (40, 0.04), (150, 0.05), (12, 0.0)] + [(3, 0.05)] * 30 + [(1, 0)] * 150:
        base = rnd.normal(size=24)
        base /= np.linalg.norm(base)
        for _ in range(size):
            rows.append((at, (base + noise * rnd.normal(size=24)).astype(np.float32).tolist()))
            at += 1
    rows += [(at, None), (at + 1, []), (at + 2, [0.0] * 24), (at + 3, [float("nan")] * 24), (at + 4, [1.0, None]), (at + 5, [float("inf")] + [0.0] * 23)]
    rows += [(at + 6, [1e-30] * 24), (at + 7, [1e30] * 24), (at + 8, [1.0] * 5), (at + 9, [2.0] * 5), (at + 10, rows[60][1])]
    return rows


def brute_vectors(rows, cosine=vg.COSINE):
    units = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            own = np.array(v, np.float64) / max(map(abs, v))
            units[i] = own / np.linalg.norm(own)
    ids = list(units)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    degree = dict.fromkeys([i for i, _ in rows], 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, smallest_reachable([i for i, _ in rows], links)


@pytest.mark.parametrize("block", [2048, 40])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vg, "BLOCK_ROWS", block)
    monkeypatch.setattr(vg, "SHARD_ROWS", 100)
    rows = vectors(3)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("class", F.lit("own")).repartition(3)
    got = {r["vec_id"]: r for r in vg.link_vectors(table).collect()}
    degree, label = brute_vectors(rows)
    assert set(got) == set(degree)
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(degree.values())
    assert all(got[i]["n_links"] <= degree[i] for i in degree)
    wrong = [i for i in degree if got[i]["component_id"] != label[i]]
    assert len(wrong) <= 0.02 * len(degree)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vector_sql_on_planted_links(spark, tmp_path):
    """The sample table has hardly a link; here groups, pairs just in range, copies and unusable vectors are planted."""
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in spread_with_pairs(40, 120, hot=25)]
    rows += [(10_000 + i, rows[i][1]) for i in range(0, 60, 7)] + [(20_000, None), (20_001, []), (20_002, [0.0] * 24), (20_003, [float("nan")] * 24), (20_004, [1.0] * 23)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    query = entry.queries()["op4_vector_graph"](spark, str(tmp_path))
    assert query.where("n_links > 0").count() > 100
    assert compare(con, entry.oracle_sql()["op4_vector_graph"], query) == ""


def test_vector_edge_cases(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vg.link_vectors(table).count() == 0
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [1.0, 0.0]), (9, None)]
    got = sorted((tuple(r)[:4] for r in vg.link_vectors(spark.createDataFrame(rows, table.schema)).collect()), key=str)
    assert got == sorted([(None, 2, 2, False), (3, 2, 2, False), (2, 2, 2, True), (3, 0, 3, True), (9, 0, 9, True)], key=str)


def test_graph_search_finds_what_is_in_range():
    rnd = np.random.default_rng(8)
    centers = rnd.normal(size=(60, 32))
    x = (centers[rnd.integers(0, 60, 1500)] + 0.1 * rnd.normal(size=(1500, 32))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, start = vg.build_graph(x)
    assert graph.shape[1] <= vg.DEGREE and (graph != np.arange(1500)[:, None]).all()
    want = x @ x.T >= 0.95
    found = np.zeros_like(want)
    for lo in range(0, 1500, 100):
        q, node = vg.range_search(graph, x, x[lo : lo + 100], start, 0.95)
        found[q + lo, node] = True
    assert not (found & ~want).any() and (found & want).sum() >= 0.99 * want.sum()


def test_recall_is_audited_and_mended(spark, monkeypatch):
    margins, placed = [], vg._placed
    monkeypatch.setattr(vg, "_placed", lambda *a: margins.append(a[2]) or placed(*a))
    monkeypatch.setattr(vg, "audit", lambda *a: 0.5 if len(margins) < 2 else 0.995)
    table = spark.createDataFrame(vectors(5)[:80], "vec_id bigint, embedding array<float>")
    assert {r["recall"] for r in vg.link_vectors(table).collect()} == {0.995}
    assert margins == [vg.MARGIN, 2 * vg.MARGIN]
    monkeypatch.setattr(vg, "audit", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="0.500"):
        vg.link_vectors(table)


def spread_with_pairs(pairs: int, singles: int, hot: int = 0) -> list[tuple]:
    """Scattered vectors, some of them with one other just in range, and one group of near copies."""
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=(pairs + singles + 1, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rnd.normal(size=(pairs, 24))
    aside -= (aside * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    other = 0.955 * x[:pairs] + np.sqrt(1 - 0.955**2) * aside
    group = x[-1] + 0.01 * rnd.normal(size=(hot, 24))
    return [(i, v.tolist()) for i, v in enumerate(np.concatenate([x[:-1], other, group]))]


def classes_of(spark, rows):
    table = vg._unit_rows(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    return table.select("class", F.lit(1).cast("bigint").alias("copies"), "unit").cache()


def test_audit_sees_few_links(spark, monkeypatch):
    monkeypatch.setattr(vg, "AUDIT_ROWS", 500)
    classes = classes_of(spark, spread_with_pairs(2, 1996))
    sample = vg.audit_sample(classes, vg.COSINE)
    assert [n for _, n in sample] == [1] * 4
    assert vg.audit(sample, classes.select("class", F.lit(0).alias("linked"))) == 0


def test_audit_is_not_hidden_by_a_hot_group(spark):
    rows = spread_with_pairs(50, 0, hot=300)
    classes = classes_of(spark, rows)
    sample = vg.audit_sample(classes, vg.COSINE)
    assert sorted(n for _, n in sample) == [1] * 100 + [299] * 300
    exact = spark.createDataFrame(sample, "class bigint, exact bigint")
    # All links of the group and none of the pairs: 0.9989 of all links.
    links = exact.select("class", F.when(F.col("exact") > 1, F.col("exact")).otherwise(0).alias("linked"))
    assert vg.audit(sample, links) == 0.75


def test_scattered_pairs_are_found_in_the_first_try(spark, monkeypatch):
    """Many small shards, pairs just in range, and a group of near copies."""
    monkeypatch.setattr(vg, "SHARD_ROWS", 64)
    rows = spread_with_pairs(600, 1500, hot=60)
    got = {r["vec_id"]: r for r in vg.link_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    degree, label = brute_vectors(rows)
    missed = [i for i in degree if got[i]["n_links"] < degree[i]]
    assert all(got[i]["n_links"] <= degree[i] for i in degree)
    assert len(missed) <= 0.01 * sum(d > 0 for d in degree.values())
    assert next(iter(got.values()))["recall"] >= 0.99


def test_overfull_shards_are_cut(spark, monkeypatch):
    """A sample for two centres only, so that all further shards come from cutting these."""
    for name, value in {"SHARD_ROWS": 64, "SPLIT_ROWS": 256, "FIT_ROWS": 16, "GROUP_ROWS": 500}.items():
        monkeypatch.setattr(vg, name, value)
    placed, sizes = vg._placed, []
    monkeypatch.setattr(vg, "_placed", lambda *a: sizes.append(t := placed(*a)) or t)
    rows = spread_with_pairs(600, 1500, hot=60)
    got = {r["vec_id"]: r for r in vg.link_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    degree, _ = brute_vectors(rows)
    assert all(got[i]["n_links"] <= degree[i] for i in degree)
    assert sum(got[i]["n_links"] < degree[i] for i in degree) <= 0.01 * sum(d > 0 for d in degree.values())
    found = [r["count"] for r in sizes[0].groupBy("shard").count().collect()]
    assert len(found) > 20 and max(found) < 1500


def test_a_vector_near_several_centres_goes_to_all_of_them():
    centres = np.eye(4)
    x = np.array([[1.0, 0, 0, 0], [0.6, 0.59, 0.54, 0], [0.5, 0.5, 0.5, 0.5]])
    assert vg._nearest_shards(x, centres, 0.05, 10) == [[10, 11], [10, 11], [10, 11, 12, 13]]
    assert vg._nearest_shards(x, centres, 0.07, 0) == [[0, 1], [0, 1, 2], [0, 1, 2, 3]]
    assert vg._nearest_shards(x, centres[:1], 0.05, 0) == [[0]] * 3

