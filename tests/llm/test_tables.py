"""Mixing, WARC archives, URL filters and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare
from tests.llm.conftest import awkward, prose
from tests.llm.test_joins import linked, smallest_reachable
from tests.llm.test_text_models import plain_counts
from tidemark.llm import boosted_quality, files, mixture, ngram_quality, partenum, url_filter, warc

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5, passes=2) -> dict:
    """Shares by weight; what is above a cap goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        left = budget - sum(passes * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if target[s] > passes * sizes[s] + 1e-9}
        if not over:
            return target | {s: passes * sizes[s] for s in capped}
        capped |= over


def check_mix(rows, source_of):
    sizes: dict = {}
    for r in rows:
        sizes[source_of(r)] = sizes.get(source_of(r), 0) + r["size"]
    target, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    largest: dict = {}
    for r in rows:
        s = source_of(r)
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    budget = 1.5 * sum(sizes.values())
    assert budget - 2 * max(largest.values()) <= sum(taken.values()) <= budget
    return target, taken, largest


def test_mix_meets_the_targets_within_a_document(spark):
    rows = [(i, prose(i, 3 + i % 50), "en", f"s{min(i % 10, 5)}" if i % 11 else None, 0) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    source = {r[0]: r[3] for r in rows}
    got = mixture.mix_sizes(table.repartition(3)).collect()
    target, taken, largest = check_mix(got, lambda r: source[r["doc_id"]])
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in target)
    again = mixture.mix_sizes(table.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_of_awkward_rows(spark, documents, clashing, none):
    got = mixture.mix_sizes(clashing).collect()
    assert len(got) == len(awkward())
    own = {(i, len(WORD.findall(t or ""))) for i, t, *_ in awkward()}
    assert {(r["doc_id"], r["size"]) for r in got} == own
    mixed = mixture.mix_documents(clashing)
    assert mixed.columns == clashing.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect())
    assert words == sum(r["taken"] for r in got)
    assert mixture.mix_sizes(none).count() == 0 and mixture.mix_documents(none).count() == 0
    blank = documents.where("doc_id between 0 and 2")
    assert {(r["target"], r["taken"]) for r in mixture.mix_sizes(blank).collect()} == {(0.0, 0)}


def plain_mix(rows, weights=mixture.WEIGHTS, passes=2) -> Counter:
    """(source, doc_id, size, times) counted, by a queue that is filled document by document."""
    size: Counter = Counter()
    for _, source, words, *_ in rows:
        size[source] += words
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, entries = 1.5 * sum(size.values()), []
    for source in order:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: r[3])
        for k in range(passes):
            at = size[source] * k
            for i, r in enumerate(own):
                at += r[2]
                if r[2]:
                    entries.append((at / weight[source], source is None, source or "", r[3], i, r))
    times: Counter = Counter()
    for *_, i, r in sorted(entries, key=lambda e: e[:5]):
        if budget < r[2]:
            break
        budget -= r[2]
        times[r[1], i, r[3]] += 1
    return times


def hot_rows() -> list[tuple]:
    """A third of all rows under one id, others under null."""
    rows = [(1, "w " * 100, "a")] * 300 + [(10 + i, "w " * 100, "a") for i in range(100)]
    rows += [(1000 + i, "v " * 100, "b") for i in range(200)] + [(None, "v " * 100, "b")] * 100
    return rows + [(2000 + i, "u " * 100, "c") for i in range(200)] + [(3000, "", "c")] * 5


def test_equal_rows_meet_their_targets_like_others(spark):
    rows = hot_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = mixture.mix_sizes(table).collect()
    assert len(got) == len(rows) and {r["taken"] // 100 for r in got if r["doc_id"] == 1} >= {1, 2}
    source = {i: s for i, _, s in rows} | {None: "b"}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)
    again = mixture.mix_sizes(table.repartition(11)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = Counter(map(tuple, mixture.mix_documents(table).select("doc_id", "source").collect()))
    counted = Counter()
    for r in got:
        counted[r["doc_id"], source[r["doc_id"]]] += r["taken"] // 100
    assert mixed == +counted


def test_mix_agrees_with_a_plain_queue(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 40), "w " * rnd.randint(0, 30), rnd.choice(["a", "a", "b", "ü", None])) for _ in range(150)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    keyed = mixture.sized_rows(table).withColumn("key", F.xxhash64(F.lit(mixture.SEED), "doc_id", "size"))
    plain = [(r["doc_id"], r["source"], r["size"], (r["key"], r["doc_id"], r["size"], r["content"])) for r in keyed.collect()]
    times = plain_mix(plain)
    want: Counter = Counter()
    for (source, _, key), n in times.items():
        want[key[1], source, key[2]] += n
    got: Counter = Counter()
    for r in mixture.mix_plan(mixture.sized_rows(table)).collect():
        got[r["doc_id"], r["source"], r["size"]] += r["times"]
    assert +got == +want


def test_mix_query_on_the_documents(spark):
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = entry.queries()["op3_mixture"](spark, FOLDER).collect()
    target, taken, largest = check_mix(got, lambda r: source[r["doc_id"]])
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in target)


BIG = "p" * 1000
PAGES = [
    (5, "http://a/é b\r\nX: 1", BIG), (3, "u", BIG), (9, None, BIG), (9, "same id", BIG), (None, "no id", BIG), (None, None, None),
    (1, "s", "tiny"), (2, "t", "tiny"), (4, "z", "y" * 999), (6, "z", "y" * 999), (5, "other", "q" * 1200), (7, "", ""), (8, "l", "é日\n" * 50_000),
]
PAGE = "page_id bigint, url string, html string"


def archived(spark, rows, **sizes):
    table = spark.createDataFrame(rows, PAGE).withColumns({"digest": F.lit("own"), "payload": F.lit(1)}).repartition(3)
    return warc.write_warc(table, files.new_folder(spark, "warc"), **sizes)


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 3000, "file_bytes": 100}])
def test_archives_hold_every_page(spark, sizes):
    rows = PAGES + [(100 + i, f"h{i}", prose(i % 40, 250)) for i in range(120)]
    manifest = archived(spark, rows, **sizes)
    got = warc.read_warc(manifest, payloads=True).collect()
    best: dict = {}
    for i, _, html in rows:
        if i is not None:
            best[html] = max(best.get(html, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= warc.REVISIT_BYTES and html in best and i != best[html]
        kind = ("revisit", best[html], None) if again else ("response", None, data)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), *kind))
    assert sorted(((r[0], *r[2:6], r[6] and bytes(r[6])) for r in got), key=str) == sorted(((*w[:5], w[5] or (b"" if w[3] == "response" else None)) for w in want), key=str)
    assert {r["url"] for r in got if r["page_id"] == 5} == {"http://a/é%20b%0D%0AX:%201", "other"}
    listed = manifest.orderBy("shard", "part").collect()
    assert all(hashlib.sha256(files.read_bytes(r["path"])).hexdigest() == r["sha256"] for r in listed)
    order = [r["page_id"] for m in listed for r in warc.read_warc(spark.createDataFrame([m])).collect()]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_archives_are_the_same_every_time(spark):
    rows = PAGES + [(100 + i, f"h{i}", prose(i, 250)) for i in range(200)]
    one, two = (archived(spark, rows, shard_bytes=20_000, file_bytes=5000) for _ in range(2))
    columns = ["shard", "part", "records", "bytes", "sha256"]
    assert one.count() > 5 and sorted(one.select(columns).collect()) == sorted(two.select(columns).collect())


@pytest.mark.parametrize("hot", [0, 300])
def test_archives_do_not_depend_on_the_input_splits(spark, hot):
    """Ties under other urls, repeated rows, and (hot) one row that would overfill a shard."""
    rows = PAGES + [(100 + i % 90, f"h{i % 120}", prose(i % 40, 250)) for i in range(400)] + [(150, "same", BIG * 2)] * hot
    table = spark.createDataFrame(rows, PAGE)
    columns = ["shard", "part", "records", "bytes", "sha256"]
    found = []
    for df in (table.coalesce(1), table.repartition(7), table.orderBy(F.desc("page_id")).repartition(3, "url")):
        manifest = warc.write_warc(df, files.new_folder(spark, "warc"), shard_bytes=60_000, file_bytes=20_000)
        found.append(sorted(manifest.select(columns).collect()))
        assert warc.read_warc(manifest).count() == len(rows)
    assert len(found[0]) > 8 and found[0] == found[1] == found[2]
    if hot:
        assert max(r["records"] for r in found[0]) < hot


def test_archives_are_plain_gzip(spark):
    (row,) = archived(spark, PAGES).collect()
    data = gzip.decompress(files.read_bytes(row["path"]))
    assert data.count(b"WARC/1.1\r\n") == len(PAGES) == row["records"]
    assert re.search(rb"WARC-Refers-To: <urn:uuid:[0-9a-f-]{36}>\r\n", data)


def test_damaged_archives_raise(spark, tmp_path):
    (row,) = archived(spark, PAGES).collect()
    data = files.read_bytes(row["path"])
    files.write_bytes(str(tmp_path), "cut.warc.gz", data[:-30])
    with pytest.raises(ValueError):
        list(warc.members(f"{tmp_path}/cut.warc.gz"))
    record = warc.record(1, "u", b"abc", None, False)
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"abc", b"abd"))


def test_archives_of_an_empty_table(spark):
    manifest = archived(spark, [])
    assert manifest.count() == 0 and warc.read_warc(manifest).count() == 0


RULES = [
    url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow"),
]


def page(i, url, canonical=None, refresh=None):
    html = "<html><head>"
    html += f'<link rel="canonical" href="{canonical}">' if canonical else ""
    html += f'<META HTTP-EQUIV="Refresh" CONTENT="0; URL={refresh}">' if refresh else ""
    return (i, url, html + "</head></html>")


URLS = [
    page(1, "http://a.net/x"), page(2, "http://a.net"), page(3, "https://www.EXAMPLE.net/en/1?q#f"), page(4, "http://example.com/de/2"),
    page(5, "http://clean.io/a", canonical="http://b.net/x"), page(6, "http://clean.io/b", refresh="http://CLEAN.io/a"),
    page(7, "http://clean.io/c"), page(8, "http://c.org/fr/1", canonical="//b.net/x"), page(9, None), (10, "no scheme", None),
    page(11, "http://d.org/en", refresh="/fr/1"), page(12, "http://notnet/x"), page(13, "http://mynet/x"), page(14, "http://e.io/p/q?x", canonical="../other"),
    page(15, "http://f.io/p/1", refresh="2"), page(16, "http://f.io/p/2", canonical="http://example.com/de/zz#top"), page(17, "http://f.io/p/1"),
    (18, "x://h.net/", ""), page(19, "http://g.io/", canonical="mailto:x@y.net"), page(20, "http://user@z.net:80/x"),
]


def plain_verdicts(pages):
    def split(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        return "".join(c.lower() if c.isascii() else c for c in host), path

    def rule(url):
        host, path = split(url)
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.text), default=None)

    def node(url):
        bare = url.split("#")[0]
        return bare.replace(re.match(r".*?://[^/?#]*|", bare)[0], re.match(r".*?://[^/?#]*|", bare)[0].lower(), 1)

    links = {5: "http://b.net/x", 6: "http://clean.io/a", 8: "http://b.net/x", 11: "http://d.org/fr/1", 14: "http://e.io/p/../other", 15: "http://f.io/p/2", 16: "http://example.com/de/zz"}
    edges = [(node(u), links[i]) for i, u, _ in pages if i in links]
    nodes = {node(u) for _, u, _ in pages if u} | {b for _, b in edges}
    label = smallest_reachable(nodes, edges)
    bad = {label[n] for n in nodes if (r := rule(n)) and r.verdict == "block"}
    out = []
    for i, url, _ in pages:
        r = rule(url)
        verdict = r.verdict if r else "block" if url and label[node(url)] in bad else "allow"
        out.append((i, *split(url), r.text if r else None, verdict))
    return out


def test_urls_against_a_plain_judge(spark):
    table = spark.createDataFrame(URLS, PAGE).withColumns({"host": F.lit("own"), "_note": F.lit(1)})
    rows = url_filter.judge_urls(table, RULES)
    got = [tuple(r) for r in rows.select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted(plain_verdicts(URLS), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[6][4] == "block" and by_id[8][4] == "allow" and by_id[7][4] == "allow" and by_id[15][4] == "block"
    assert url_filter.judge_urls(table.where("false"), RULES).count() == 0


def test_all_links_of_a_page_and_empty_paths(spark):
    bad, fine = "http://b.net/x", "http://fine.io/x"
    cases = {  # html and whether it makes the page an alias of a blocked one
        f'<link rel="canonical" href="{fine}"><link rel="canonical" href="{bad}">': True,
        f'<meta http-equiv="refresh" content="9; url={fine}"><meta http-equiv="refresh" content="9; url={bad}">': True,
        f'<link rel="shortlink canonical" href="{bad}">': True,
        f"<link href={bad} rel=' me\ncanonical next'>": True,
        f"<link href={fine} rel=canonical><link href={bad} rel=canonical>": True,
        f'<link rel="not-canonical canonicals" href="{bad}">': False,
        '<link rel="canonical" href="http://k.net">': False,  # no rule fits it as it is written
        '<link rel="canonical" href="http://b.net/">': True,
    }
    pages = [(i, f"http://own{i}.io/p", html) for i, html in enumerate(cases)]
    pages += [(50, "http://Old.io", ""), (51, "http://moved.io/", f'<link rel="canonical" href="{bad}">'), (52, "http://moved.io", "")]
    pages += [(53, "http://b.net", ""), (54, "http://b.net?q", ""), (55, "http://c.org", "")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(pages, PAGE), RULES).collect()}
    want = {i: "block" if hit else "allow" for i, hit in enumerate(cases.values())}
    assert got == want | {50: "allow", 51: "block", 52: "block", 53: "allow", 54: "allow", 55: "allow"}


def test_a_form_is_judged_alike_with_and_without_links(spark):
    """The host of `http://x.net` has rules for paths only; an alias with a path does not change that for itself."""
    fine = '<link rel="canonical" href="http://fine.io/x">'
    pages = [(1, "http://x.net", fine), (2, "http://z.net", ""), (3, "http://x.net/", ""), (4, "http://fine.io/x", ""), (5, "http://y.net/", '<link rel="canonical" href="http://y.net">')]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(pages, PAGE), RULES).collect()}
    assert got == {1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "block"}
    linked_ = [(1, "http://x.net/", fine), (2, "http://fine.io/x", ""), (3, "http://x.net", "")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(linked_, PAGE), RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


def test_columns_named_like_inner_ones_stay(spark):
    table = spark.createDataFrame(URLS, PAGE)
    extra = table.withColumns({c: F.lit(f"own {c}") for c in ("_alias", "_node", "_rule", "_page", "node", "component", "rule")})
    rows = url_filter.judge_urls(extra, RULES)
    assert rows.columns == [*PAGE.replace(" bigint", "").replace(" string", "").split(", "), "_alias", "_node", "_rule", "_page", "node", "component", "host", "path", "rule", "verdict"]
    got = sorted(map(tuple, rows.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert got == sorted(plain_verdicts(URLS), key=str)
    assert {r["_alias"] for r in rows.collect()} == {"own _alias"}


def test_url_sql_on_pages_with_links(spark, tmp_path):
    html = ['<link href="{}" rel="shortlink canonical">', "<LINK rel=canonical href={}><link rel='canonical' href='http://fine.io/x'>", '<meta http-equiv="refresh" content="0; url={}">']
    targets = ["http://b.net/x", "/de/1", "//b.net", "other", "http://example.com/de/zz#top", "http://fine.io/x", "mailto:a@b", "http://B.net/x?a=1&amp;b=2"]
    pages = [(i, f"http://own{i % 9}.io{['', '/p/q', '/p?x'][i % 3]}", html[i % 3].format(targets[i % 8])) for i in range(60)] + URLS
    pages += [(900, "http://x.net", html[0].format("http://fine.io/y")), (901, "http://fine.io/y", None), (902, "http://x.net/", "")]
    spark.createDataFrame(pages, PAGE).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert compare(con, entry.oracle_sql()["op10_url_filter"], entry.queries()["op10_url_filter"](spark, str(tmp_path))) == ""


def test_redirect_tables_and_rule_limits(spark):
    table = spark.createDataFrame(URLS, PAGE)
    moved = spark.createDataFrame([("http://clean.io/c", "http://old.net/"), (None, "x")], "from_url string, to_url string")
    rows = url_filter.judge_urls(table, RULES, moved)
    assert rows.where("page_id = 7").first()["verdict"] == "block"
    with pytest.raises(ValueError):
        url_filter.judge_urls(table, RULES * 200)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of documents (a part of the sample and awkward rows) and labels."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 250")
    odd = spark.createDataFrame(awkward(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 5000)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_stages_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.materialize(stage(spark, docs, small))
        kept[name] = (before, docs.collect(), docs.columns)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(k[2] == columns for k in list(kept.values())[:-1])

    table = spark.read.parquet(f"{small}/documents.parquet")
    key = lambda r: tuple(map(str, r))
    before, after, _ = kept["quality classifier"]
    scores = boosted_quality.score(table, boosted_quality.train(table, labels)).collect()
    assert sorted(after, key=key) == sorted((r[:5] for r in scores if r["score"] >= 0.5), key=key)

    before, after, _ = kept["quality rules"]
    model = ngram_quality.train(table, labels)
    passed = {r["text"] for r in ngram_quality.judge(table, model).where("kept").collect()}
    assert sorted(after, key=key) == sorted((r for r in before if r["text"] in passed), key=key)
    assert all(plain_counts(r["text"])[0] >= 50 for r in after)

    before, after, _ = kept["n-gram Jaccard join"]
    found, _ = linked([r["text"] for r in before], partenum.WORDS, partenum.PERCENT)
    label = smallest_reachable(range(len(before)), found)
    group: dict = {}
    for i, g in label.items():
        group.setdefault(g, []).append(before[i])
    assert len(after) == len(group)
    least = [min((r["doc_id"] for r in g if r["doc_id"] is not None), default=None) for g in group.values()]
    assert sorted(str(r["doc_id"]) for r in after) == sorted(map(str, least))

    before, after, _ = kept["mixing sources to target weights"]
    size = lambda r: len(WORD.findall(r["text"] or ""))
    budget = 1.5 * sum(map(size, before))
    assert budget - 2 * max(map(size, before)) <= sum(map(size, after)) <= budget
    assert all(after.count(r) in (0, 1, 2) for r in before)

    before, after, names = kept["SentencePiece encoding and decoding"]
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    assert names == ["doc_id", "lang", "source", "n_chars", "ids", "n_ids", "ids_crc32"]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in after) == sorted((str(r["doc_id"]), library.encode(r["text"])) for r in before)


def test_pipeline_of_empty_tables_and_extra_columns(spark, small, tmp_path, clashing, none):
    folder = str(tmp_path)
    none.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing, small)
        assert set(clashing.columns) - {"text"} <= set(out.columns), name
        assert out.count() >= 0


def test_pipeline_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join"
