"""N-gram Jaccard self-join with PartEnum signatures.

A document's set holds its distinct word shingles. Two sets of sizes a and b reach the similarity t
only if they differ in at most (1 - t) / (1 + t) * (a + b) elements. Sizes are cut into bands; a set
takes part in its own band and in each band above that a similar set could be in. For a band with
at most k differing elements the domain is cut by hash into n1 parts of n2 subparts, so that
one part at least has no more than k2 differences, and then one choice of n2 - k2 subparts
has none: the signatures of all such choices contain one that both sets share.

* Bands below GUARANTEED elements: k2 = 2, n2 = 5, one part more than needed. A choice without
  elements is no signature, except for the few sets with so many of them that
  the spare part does not make up for it. Such sets also give their empty choices, so no pair is lost.
* Larger bands: k2 = 1, n2 = 2. Choices without elements are left out; a similar pair is lost only if
  all subparts on which it agrees are empty, with probability below 1e-12 over the hash.

Sets are told apart by a 64-bit fingerprint: copies are one class, and two different classes among n
share a fingerprint with probability n^2 / 2^65.

A bucket (classes with one signature) is not turned into all its pairs. Every class is compared
with the bucket's pivot, the class with most shared signatures; verified links give components. Only
in buckets that still hold several components are the remaining pairs across components compared,
each class outside the bucket's largest component with the rest. So the components are those of all links. Many unlike
sets may share a signature of a few common shingles. In buckets of more than LARGE_BUCKET classes only
those pairs are compared that also share a signature of a second, independent cut of the domain, as similar sets do: what
unlike sets share by chance in one cut, they hardly share in both.

Comparing begins with sketches: SKETCH parity bits of the set's hashes. Every differing element flips
one bit, so sets whose sketches differ in more bits than the allowed differences are no link, and
that test is a condition inside the join. What passes is verified on the shingle sets.

Defined cases: a null or empty text has an empty set and links with nothing; a text with fewer words
than a shingle is one shingle; rows with equal texts are one class whatever their ids; null ids are
kept (a component of null ids only has a null id); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import Texts, Words, mix, repeated, slices, windows
from tidemark.llm.components import connected_components
from tidemark.plans.materialize import Scratch, materialize

RATIO = 1.5  # of the sizes of neighbouring bands
GUARANTEED = 128
WORDS, PERCENT = 5, 80
LARGEST = 1 << 40
SKETCH = 1024  # bits
#: Rows of two or three numbers that are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_CLASSES = 200_000
LARGE_BUCKET = 1024  # classes above which those of several components are told apart by second signatures


@lru_cache(4)
def bands(percent: int) -> list[int]:
    """First sizes of the bands."""
    ratio, firsts = max(RATIO, 100 / percent), [1]
    while firsts[-1] < LARGEST:
        firsts.append(max(firsts[-1] + 1, int(firsts[-1] * ratio)))
    return firsts


@lru_cache(256)
def plan(band: int, percent: int) -> tuple[int, int, list[tuple[int, ...]], int]:
    """(parts, subparts of a part, choices, spare parts) of a band; no parts if only equal sets can match."""
    last = bands(percent)[band + 1] - 1
    k = (100 - percent) * 2 * last // (100 + percent)
    if k < 1:
        return 0, 0, [], 0
    if bands(percent)[band] < GUARANTEED:
        return k // 3 + 2, 5, list(combinations(range(5), 3)), 1
    return k // 2 + 1, 2, [(0,), (1,)], 0


def sets_of(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a slice: (hash, text), by text and hash."""
    words = Words(texts)
    hashes = words.hashes(lower=True)
    found, owner, _ = windows(hashes, words.first, words.last, n)
    for count in range(1, n):  # short texts are one shingle of all their words
        short = np.flatnonzero(words.count == count)
        if len(short):
            whole, own, _ = windows(hashes, words.first[short], words.last[short], count)
            found, owner = np.concatenate([found, whole]), np.concatenate([owner, short[own]])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], owner[new]


def fingerprints(found: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, fingerprint) of each text's set."""
    size = np.bincount(owner, minlength=texts)
    total = np.zeros(texts, np.uint64)
    some = size > 0
    if some.any():
        total[some] = np.add.reduceat(mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A)), np.flatnonzero(np.diff(owner, prepend=-1)))
    return size, mix(total + size.astype(np.uint64)).view(np.int64)


def sketches(found: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Parity of the number of elements in each of SKETCH cells, as 64-bit numbers."""
    cell = (mix(found + np.uint64(0x2545F4914F6CDD1D)) & np.uint64(SKETCH - 1)).astype(np.int64)
    odd = (np.bincount(owner * SKETCH + cell, minlength=texts * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, SKETCH), axis=1).view(np.int64)


def may_link(a: str, b: str, percent: int) -> Column:
    """False only for pairs whose sizes or sketches (structs `a` and `b`) rule a link out."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    words = range(SKETCH // 64)
    differing = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in words), F.lit(0))
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (differing * (100 + percent) <= (n + m) * (100 - percent))


def signatures(found: np.ndarray, owner: np.ndarray, size: np.ndarray, wanted: np.ndarray, percent: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text) of the wanted texts' sets; another seed cuts the domain into other parts."""
    firsts = bands(percent)
    start = np.cumsum(size) - size
    groups: dict[int, list[int]] = {}
    for text in np.flatnonzero(wanted).tolist():
        own = bisect_right(firsts, size[text]) - 1
        highest = bisect_right(firsts, 100 * int(size[text]) // percent) - 1
        for band in range(own, highest + 1):
            groups.setdefault(band, []).append(text)
    spread = mix(found + np.uint64(0x632BE59BD9B4E019 + seed)) >> np.uint64(32)
    value = mix(found)
    out, of = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for band, members in groups.items():
        parts, subparts, choices, spare = plan(band, percent)
        if not parts:
            continue
        cells, ids = parts * subparts, np.array(members)
        n = size[ids]
        row = np.repeat(np.arange(len(ids)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[ids], n)
        cell = row * cells + ((spread[at] * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        ranked = cell[order]
        head = np.flatnonzero(np.diff(ranked, prepend=-1))
        sums, held = np.zeros(len(ids) * cells, np.uint64), np.zeros(len(ids) * cells, bool)
        sums[ranked[head]] = np.add.reduceat(value[at][order], head)
        held[ranked[head]] = True
        sums, held = sums.reshape(len(ids), parts, subparts), held.reshape(len(ids), parts, subparts)
        chosen = np.stack([sums[:, :, c].sum(2, dtype=np.uint64) for c in choices], 2)
        filled = np.stack([held[:, :, c].any(2) for c in choices], 2)
        if spare:
            sparse = (~filled).any(2).sum(1) > spare
            filled |= sparse[:, None, None]
        name = np.arange(parts * len(choices), dtype=np.uint64).reshape(parts, len(choices)) + np.uint64(band << 40)
        text, part, choice = np.nonzero(filled)
        out.append(mix(chosen[text, part, choice] ^ mix(name)[part, choice]))
        of.append(ids[text])
    return np.concatenate(out), np.concatenate(of)


def _profiles(documents: DataFrame, n: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, class, sketch) of every document."""

    def work(batches):
        for b in batches:
            for texts in slices(field(b, "text")):
                found, owner = sets_of(texts, n)
                size, print_ = fingerprints(found, owner, len(texts))
                part = b.slice(texts.first, len(texts))
                marks = pa.array(list(sketches(found, owner, len(texts))), pa.list_(pa.int64()))
                columns = [field(part, "doc_id"), field(part, "text_key"), pa.array(size.astype(np.int64)), pa.array(print_, mask=size == 0), marks]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "class", "sketch"])

    schema = "doc_id bigint, text_key bigint, n_shingles bigint, class bigint, sketch array<bigint>"
    rows = documents.select(F.col("doc_id").cast("bigint"), _text_key().alias("text_key"), "text")
    return map_batches(rows, schema, work)


def _signature_rows(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, other, settled): the signatures of all classes, combined in batches before the shuffle.

    A batch's copies of a class give its signatures once. The first class of a batch with a signature is a row
    (signature, class, false). Where several classes of a batch have it in common, each of them is also a row
    (class, signature, true): settled, so it needs no look at other batches, and keyed by the class. A
    signature thus has one row a batch under its key, however many classes have it.
    """

    def work(batches):
        for b in batches:
            sigs, classes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            seen = np.empty(0, np.int64)
            for texts in slices(field(b, "text")):
                found, owner = sets_of(texts, n)
                size, print_ = fingerprints(found, owner, len(texts))
                wanted = np.zeros(len(texts), bool)
                wanted[np.unique(print_, return_index=True)[1]] = True
                wanted &= (size > 0) & ~np.isin(print_, seen)
                seen = np.union1d(seen, print_)
                sig, of = signatures(found, owner, size, wanted, percent)
                sigs.append(sig)
                classes.append(print_[of])
            sig, class_ = np.concatenate(sigs), np.concatenate(classes)
            first = np.sort(np.unique(sig, return_index=True)[1])
            again = np.flatnonzero(repeated(sig))
            sig = sig.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([sig[first], class_[again]])),
                    pa.array(np.concatenate([class_[first], sig[again]])),
                    pa.array(np.arange(len(first) + len(again)) >= len(first)),
                ],
                ["key", "other", "settled"],
            )

    return map_batches(documents.select("text"), "key bigint, other bigint, settled boolean", work)


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _broadcast_if_small(stored: DataFrame) -> DataFrame:
    return F.broadcast(stored) if stored.count() <= BROADCAST_CLASSES else stored


def _sets(documents: DataFrame, info: DataFrame, pairs: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """(class, shingles): the sorted shingle hashes of one text of each class in the pairs, as bytes."""
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = scratch.keep(ends.join(info, "class").select(F.col("class").alias("_class"), F.col("doc_id").alias("_doc")))
    wanted = _broadcast_if_small(wanted)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("_class", "text")

    def work(batches):
        for b in batches:
            asked = np.array(field(b, "_class"))
            for texts in slices(field(b, "text")):
                found, owner = sets_of(texts, n)
                size, print_ = fingerprints(found, owner, len(texts))
                edge = np.concatenate(([0], np.cumsum(size)))
                # Ids may repeat, so the text at hand may be another one of that id.
                same = np.flatnonzero(print_ == asked[texts.first : texts.last])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(print_[same]), pa.array([found[edge[i] : edge[i + 1]].tobytes() for i in same], pa.binary())],
                    ["class", "shingles"],
                )

    return scratch.keep(map_batches(texts, "class bigint, shingles binary", work).dropDuplicates(["class"]))


def _second_signatures(documents: DataFrame, info: DataFrame, classes: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    """(class, second): signatures of another cut of the domain that several of the classes share."""
    wanted = scratch.keep(classes.join(info, "class").select(F.col("class").alias("_class"), F.col("doc_id").alias("_doc")))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.join(_broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("_doc"))).select("_class", "text")

    def work(batches):
        for b in batches:
            asked = np.array(field(b, "_class"))
            for texts in slices(field(b, "text")):
                found, owner = sets_of(texts, n)
                size, print_ = fingerprints(found, owner, len(texts))
                sig, of = signatures(found, owner, size, print_ == asked[texts.first : texts.last], percent, seed=1)
                yield pa.RecordBatch.from_arrays([pa.array(print_[of]), pa.array(sig.view(np.int64))], ["class", "second"])

    rows = map_batches(texts, "class bigint, second bigint", work).distinct()
    seen = F.count(F.lit(1)).over(Window.partitionBy("second"))
    return scratch.keep(rows.withColumn("_n", seen).where("_n > 1").drop("_n"))


def _verified(documents: DataFrame, info: DataFrame, pairs: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. `a` may be a hub, so its set is joined to
    the slim pairs first. The sets are dropped as soon as the pairs are stored."""

    def work(batches):
        for b in batches:
            keep = []
            for one, two in zip(field(b, "left"), field(b, "right"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with Scratch(documents.sparkSession) as own:
        sets = _sets(documents, info, pairs, n, own)
        left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return scratch.keep(map_batches(joined, "a bigint, b bigint", work))


def class_links(documents: DataFrame, profiles: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): verified links between classes, enough of them to give the components of all links. They
    are read from tables of `scratch`."""
    # One shuffle and one sort: the rows of a key, at most one a batch, are looked at where they lie.
    rows = _signature_rows(documents, n, percent).repartition("key")
    of_key = Window.partitionBy("key")
    seen = {"_low": F.min("other"), "_high": F.max("other"), "_any": F.bool_or("settled")}
    found = rows.withColumns({name: value.over(of_key) for name, value in seen.items()}).where("_low < _high or _any")
    sig, class_ = (F.when(F.col("settled"), F.col(a)).otherwise(F.col(b)) for a, b in (("other", "key"), ("key", "other")))
    shared = scratch.keep(found.select(sig.alias("sig"), class_.alias("class")).distinct())
    held = shared.groupBy("class").agg(F.count(F.lit(1)).alias("weight"))
    about = profiles.join(held.select("class"), "class", "left_semi").groupBy("class")
    info = scratch.keep(about.agg(F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch")))

    def known(name: str) -> DataFrame:
        return info.select(F.col("class").alias(name), F.struct("n_shingles", "sketch").alias(f"{name}_info"))

    # Weight and class in one number of a fixed width, which keeps this a hash aggregate.
    apart, shift = F.lit(str(1 << 64)).cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)")
    heaviest = F.max(F.col("weight").cast("decimal(10,0)") * apart + F.col("class").cast("decimal(20,0)") + shift)
    pivots = shared.join(held, "class").groupBy("sig").agg(heaviest.alias("_best"), F.count(F.lit(1)).alias("members"))
    pivots = scratch.keep(pivots.select("sig", (F.col("_best") % apart - shift).cast("bigint").alias("pivot"), "members"))
    star = shared.join(pivots, "sig").where("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b"))
    star = star.distinct().join(known("a"), "a").join(known("b"), "b").where(may_link("a_info", "b_info", percent))
    links = _verified(documents, info, scratch.keep(star.select("a", "b")), n, percent, scratch)

    # Of a bucket of two, the one pair has been compared.
    groups = connected_components(links, "a", "b").withColumnRenamed("node", "class")
    wide = shared.join(pivots.where("members > 2"), "sig").join(groups, "class", "left")
    placed = scratch.keep(wide.select("sig", "class", "pivot", F.coalesce("component", "class").alias("component")))
    counts = placed.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "component")).getField("component")
    torn = counts.groupBy("sig").agg(largest.alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("size")).where("parts > 1")
    # The pivot has been compared with all the others.
    open_ = placed.where("class <> pivot").join(torn.select("sig", "main", "size"), "sig")
    open_ = scratch.keep(open_.select("sig", "class", "component", "main", "size"))
    each = open_.where(F.col("size") <= LARGE_BUCKET).withColumn("second", F.lit(0).cast("bigint"))
    large = open_.where(F.col("size") > LARGE_BUCKET)
    if large.head(1):
        second = _second_signatures(documents, info, large.select("class").distinct(), n, percent, scratch)
        each = each.unionByName(large.join(second, "class").select(*each.columns))
    each = scratch.keep(each.join(info.select("class", F.struct("n_shingles", "sketch").alias("info")), "class"))
    odd = each.where("component <> main").select("sig", "second", F.col("class").alias("a"), F.col("component").alias("own"), F.col("info").alias("a_info"))
    other = each.select("sig", "second", F.col("class").alias("b"), "component", "main", F.col("info").alias("b_info"))
    across = (odd.sig == other.sig) & (odd.second == other.second)
    across &= (F.col("own") != F.col("component")) & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("b")))
    rest = odd.join(other, across & may_link("a_info", "b_info", percent))
    rest = scratch.keep(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return links.unionByName(_verified(documents, info, rest, n, percent, scratch))


def _named(documents: DataFrame, profiles: DataFrame, n: int, percent: int) -> DataFrame:
    """(class, group, component_id) of every class: the smallest class and doc_id that links reach."""
    with Scratch(documents.sparkSession) as scratch:
        links = class_links(documents, profiles, n, percent, scratch)
        groups = materialize(connected_components(links, "a", "b").withColumnRenamed("node", "class"))
    classes = profiles.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    placed = classes.join(groups, "class", "left").select("class", "doc_id", F.coalesce("component", "class").alias("group"))
    placed = materialize(placed)
    least = placed.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return materialize(placed.join(least, "group").select("class", "group", "component_id"))


def near_duplicates(documents: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document (doc_id, text): the size of its set and the
    smallest doc_id that links reach, with 100 * intersection >= percent * union for each link."""
    profiles = materialize(_profiles(documents, n))
    named = _named(documents, profiles, n, percent).drop("group")
    rows = profiles.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(documents: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of linked documents, with its own columns: that with the smallest
    doc_id, and of several with that id the smallest row. Documents without words all stay.

    What goes is taken out by an anti join on (doc_id, hash of the text). Its keys, two numbers each, are
    broadcast up to BROADCAST_CLASSES of them, so that texts need no shuffle; beyond, the join shuffles.
    """
    columns = documents.columns
    profiles = materialize(_profiles(documents, n))
    named = _named(documents, profiles, n, percent)
    slim = profiles.where("class is not null").select("class", "doc_id", "text_key").join(named, "class")
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = slim.where(is_first).select("group", "doc_id", "text_key")
    several = materialize(first.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group"))
    twins = materialize(first.join(several, "group").distinct())
    gone = slim.where(~is_first).select("doc_id", "text_key").union(twins.select("doc_id", "text_key")).distinct()

    rows = documents.select(F.struct(*columns).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), _text_key().alias("_key"))

    def same(keys: DataFrame):
        return F.col("_id").eqNullSafe(keys["doc_id"]) & (F.col("_key") == keys["text_key"])

    gone = _broadcast_if_small(materialize(gone))
    kept = rows.join(gone, same(gone), "left_anti").select("_row")
    if not several.isEmpty():
        small = _broadcast_if_small(twins)
        of_several = rows.join(small, same(small)).groupBy("group").agg(F.min("_row").alias("_row"))
        kept = kept.unionByName(of_several.select("_row"))
    return kept.select("_row.*")
