"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are folded (A-Z), split into pieces at `.,;:!?` and line breaks, and pieces into words at blanks and
tabs. Per language, the graph has an edge for each run of LONGEST words: from its first LONGEST - 1 words
to its last ones, weighted by its occurrences. At the end of a piece an edge is shorter; those are the
corrections that let shorter phrases be counted from edges alone: a phrase occurs as often as the
edges that begin with it weigh together (the flow out of its node, and what ends there).

1. Words are counted per language. A word below `least` occurrences cannot be part of a candidate, so it ends a
   piece. Which words are frequent is known to tasks through a bit filter of fixed size; a
   false hit costs an edge and changes no count.
2. Tasks cut texts into edges, add up equal ones, and deal them by their first two words. A prefix that
   begins more than 1 / HOT_SHARE of all edges (so there are few of them) is dealt by one word more, up
   to the whole edge; groups stay small however common a pair or a passage is. Edges travel packed, many in
   a row: the TABLE_WORDS most frequent words as places in a table, others as fingerprints.
3. Each group of edges is sorted once; runs of equal prefixes give all counts. Where the prefix is hot,
   groups hold parts of the sum and hand on all of them, else they hand on what reaches `least`.
4. A unary path (a node whose whole weight flows through one edge) is compacted into the longer phrase: a
   candidate is dropped if an extension by one word, to either side, keeps `keep_percent` of its
   occurrences. Extensions by more words imply one by one word, as counts never rise.
5. Cuts join the counts of both parts; scores are exact decimals; the best of each language are ranked.

Words are known by 64-bit fingerprints (of language and bytes) until the ranked phrases get their text.
Two frequent words of a corpus share one with probability n^2 / 2^65.

Defined cases: a null text is empty; a null language is `und`, the same as the language of that
name; repeated rows and null ids count like others; no table rows, or no phrase with `least` occurrences, give no rows;
columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import _LOWER as LOWER
from tidemark.llm.bytescan import Texts, mix, slices, span_hashes
from tidemark.plans.materialize import Scratch, materialize

LONGEST = 5  # words of an edge and of a phrase
CHUNK_WORDS = 1 << 19  # words whose edges are added up at once
GROUP_WORDS = 1 << 20  # words of the corpus for each group of edges
FILTER_BITS = 26
TABLE_WORDS = 1 << 19  # most frequent words, which travel as their places in a table that all tasks have
HOT_SHARE, STRIDE = 1024, 16  # a hot prefix's least share of all places; of which one in STRIDE is looked at
TOTAL, WORD, PREFIX = 0, 1, 2

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(10, 14)]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True


class Tokens:
    """Words of a slice: fingerprints per language, spans, and the piece that each is in."""

    def __init__(self, texts: Texts, language: np.ndarray):
        self.data = LOWER[texts.data]
        gap = GAP[self.data]
        before = np.concatenate(([True], gap[:-1]))
        self.begin, self.end = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
        self.text = np.searchsorted(texts.begin, self.begin, "right") - 1
        breaks = np.flatnonzero(BREAK[self.data])  # the line feed after each text is one
        self.piece = np.searchsorted(breaks, self.begin)
        self.prints = mix(span_hashes(self.data, self.begin, self.end) ^ mix(language.view(np.uint64)[self.text]))

    def spell(self, which: np.ndarray) -> pa.Array:
        """The bytes of some words as strings."""
        begin, size = self.begin[which], (self.end - self.begin)[which]
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.data[at].tobytes()))


def _prefix_prints(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the first `length` words of each edge (a row of fingerprints)."""
    total = np.full(len(words), length, np.uint64)
    for j in range(length):
        total = mix(total ^ words[:, j]) + np.uint64(j + 1)
    return total


def edges_of(prints: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """A row of LONGEST fingerprints for each word: it and those after it in its piece, then zeros."""
    out = np.zeros((len(prints), LONGEST), np.uint64)
    if len(prints):
        stop = np.flatnonzero(np.diff(piece, append=-1))
        left = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(len(prints))
        out[:, 0] = prints
        for j in range(1, LONGEST):
            has = np.flatnonzero(left >= j)
            out[has, j] = prints[has + j]
    return out


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Rows (kind, lang, print, word, n) of words, of all words, and of prefixes that are common here."""
    for b in batches:
        names, keys = field(b, "lang"), np.array(field(b, "lang_key"), np.int64)
        for texts in slices(field(b, "text")):
            own = keys[texts.first : texts.last]
            tokens = Tokens(texts, own)
            prints, first, n = np.unique(tokens.prints, return_index=True, return_counts=True)
            lang = names.take(pa.array(texts.first + tokens.text[first]))
            yield _rows(WORD, lang, prints, tokens.spell(first), n)
            _, one, which = np.unique(own, return_index=True, return_inverse=True)
            n = np.bincount(which[tokens.text], minlength=len(one))
            yield _rows(TOTAL, names.take(pa.array(texts.first + one)), np.zeros(len(one), np.uint64), pa.nulls(len(one), pa.string()), n)
            edges = edges_of(tokens.prints, tokens.piece)[::STRIDE]
            for length in range(2, LONGEST):
                found, n = np.unique(_prefix_prints(edges[edges[:, length - 1] != 0], length), return_counts=True)
                common = n * 2 * HOT_SHARE > max(len(edges), 4 * HOT_SHARE)
                yield _rows(PREFIX, pa.nulls(int(common.sum()), pa.string()), found[common], pa.nulls(int(common.sum()), pa.string()), n[common])


def _rows(kind: int, lang: pa.Array, prints: np.ndarray, word: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(n), kind, np.int32)), lang.cast(pa.string()), pa.array(prints.view(np.int64)), word, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["kind", "lang", "print", "word", "n"])


def frequent_filter(words: DataFrame) -> np.ndarray:
    """Bits at the places of all fingerprints; 2^FILTER_BITS of them whatever the number of words."""
    place = F.shiftrightunsigned("print", 64 - FILTER_BITS)
    cell = F.shiftrightunsigned(place, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for c, bits in words.groupBy(cell.alias("cell")).agg(F.bit_or(bit)).collect():
        out[c] = bits
    return out.view(np.uint64)


def _is_frequent(prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = prints >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def deal(edges: np.ndarray, hot: np.ndarray, groups: int) -> np.ndarray:
    """The group of each edge: by its first two words, and by as many more as its prefix is hot."""
    key = _prefix_prints(edges, 2)
    left = np.flatnonzero(np.isin(key, hot) & (edges[:, 2] != 0))
    for length in range(3, LONGEST + 1):
        if not len(left):
            break
        key[left] = _prefix_prints(edges[left], length)
        if length < LONGEST:
            left = left[np.isin(key[left], hot) & (edges[left, length] != 0)]
    return (mix(key) % np.uint64(groups)).astype(np.int64)


def pack(edges: np.ndarray, n: np.ndarray, table: np.ndarray) -> bytes:
    """Edges and their numbers, compressed: places in `table` (ascending fingerprints) for the words that are in it,
    and in a table of the row's own for the others."""
    at = np.minimum(np.searchsorted(table, edges), len(table) - 1)
    outside = table[at] != edges
    own = np.unique(edges[outside])
    at[outside] = len(table) + np.searchsorted(own, edges[outside])
    # The first bytes of all places, then the second ones: high bytes are mostly equal.
    planes = np.ascontiguousarray(at.T.astype("<u4")).reshape(-1).view(np.uint8).reshape(-1, 4).T
    n = n.astype("<u4" if n.max() < 1 << 32 else "<u8")
    head = np.array([len(edges), len(own), n.itemsize], "<u8")
    return zstandard.ZstdCompressor(level=3).compress(b"".join(np.ascontiguousarray(x).tobytes() for x in (head, own.astype("<u8"), planes, n)))


def unpack(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    rows, count, size = np.frombuffer(raw, "<u8", 3).tolist()
    own = np.frombuffer(raw, "<u8", count, 24)
    planes = np.frombuffer(raw, np.uint8, 4 * rows * LONGEST, 24 + 8 * count)
    at = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(LONGEST, rows).T.astype(np.int64)
    n = np.frombuffer(raw, f"<u{size}", rows, 24 + 8 * count + 4 * rows * LONGEST)
    words = table[np.minimum(at, len(table) - 1)]
    outside = at >= len(table)
    words[outside] = own[at[outside] - len(table)]
    return words, n.astype(np.int64)


def _added_up(edges: np.ndarray, hot: np.ndarray, groups: int, table: np.ndarray) -> pa.RecordBatch:
    """Equal edges as one, a packed row for each group."""
    group = deal(edges, hot, groups)
    # By group, then by a hash of the edge: equal edges become neighbours.
    key = _prefix_prints(edges, LONGEST)
    order = np.lexsort((key, edges[:, 0], group))
    edges, group, key = edges[order], group[order], key[order]
    new = np.ones(len(edges), bool)
    new[1:] = (key[1:] != key[:-1]) | (edges[1:] != edges[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    n, edges, group = np.diff(first, append=len(new)), edges[first], group[first]
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    packed = [pack(edges[lo:hi], n[lo:hi], table) for lo, hi in zip(begin, [*begin[1:], len(group)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(group[begin]), pa.array(packed, pa.binary())], ["group", "edges"])


class _Shared(NamedTuple):
    """What all tasks know; its size is bounded by FILTER_BITS, TABLE_WORDS and HOT_SHARE."""

    bits: np.ndarray
    table: np.ndarray
    hot: np.ndarray


def common_words(words: DataFrame) -> np.ndarray:
    """Fingerprints of the TABLE_WORDS most frequent words, ascending, and 0 for no word."""
    most = words.select("print", "n").orderBy(F.desc("n"), "print").limit(TABLE_WORDS).select("print").toArrow()
    return np.unique(np.append(np.array(most["print"], np.int64).view(np.uint64), np.uint64(0)))


def _edge_rows(documents: DataFrame, shared, groups: int) -> DataFrame:
    def work(batches):
        bits, table, hot = shared.value
        parts, size = [], 0
        for b in batches:
            keys = np.array(field(b, "lang_key"), np.int64)
            for texts in slices(field(b, "text")):
                tokens = Tokens(texts, keys[texts.first : texts.last])
                known = _is_frequent(tokens.prints, bits)
                # A rare word ends a piece like a full stop does.
                prints, piece = tokens.prints[known], (tokens.piece + np.cumsum(~known))[known]
                for lo in range(0, len(prints), CHUNK_WORDS):  # a very long text, a part at a time
                    reach = slice(lo, lo + CHUNK_WORDS + LONGEST - 1)
                    edges = edges_of(prints[reach], piece[reach])[:CHUNK_WORDS]
                    edges = edges[edges[:, 1] != 0]  # single words are counted already
                    parts.append(edges)
                    size += len(edges)
                    if size >= CHUNK_WORDS:
                        yield _added_up(np.concatenate(parts), hot, groups, table)
                        parts, size = [], 0
        if size:
            yield _added_up(np.concatenate(parts), hot, groups, table)

    return map_batches(documents, "group bigint, edges binary", work)


def prefix_counts(edges: np.ndarray, n: np.ndarray, hot: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrases, occurrences) of prefixes of two and more words that weigh `least`, or that are hot."""
    order = np.lexsort(edges.T[::-1])
    edges, n = edges[order], n[order]
    before = np.concatenate(([0], np.cumsum(n)))
    found, weights = [], []
    same = np.zeros(len(edges), bool)
    same[1:] = edges[1:, 0] == edges[:-1, 0]
    for length in range(2, LONGEST + 1):
        same[1:] &= edges[1:, length - 1] == edges[:-1, length - 1]
        begin = np.flatnonzero(~same)
        weight = before[np.append(begin[1:], len(edges))] - before[begin]
        rows = edges[begin]
        keep = weight >= least
        if length < LONGEST:
            keep |= np.isin(_prefix_prints(rows, length), hot)
        keep &= rows[:, length - 1] != 0
        rows = rows[keep]
        rows[:, length:] = 0
        found.append(rows)
        weights.append(weight[keep])
    return np.concatenate(found), np.concatenate(weights)


def _phrase_counts(rows: DataFrame, shared, least: int) -> DataFrame:
    """(words, a): all phrases of two and more words that occur `least` times."""

    def work(group: pa.Table) -> pa.Table:
        _, table, hot = shared.value
        edges, n = (np.concatenate(x) for x in zip(*[unpack(e, table) for e in group["edges"].to_pylist()], strict=True))
        found, n = prefix_counts(edges, n, hot, least)
        size = np.count_nonzero(found, axis=1)
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[found != 0].view(np.int64)))
        return pa.table({"words": words, "a": pa.array(n)})

    counted = rows.groupBy("group").applyInArrow(work, "words array<bigint>, a bigint")
    return counted.groupBy("words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored_phrases(phrases: DataFrame, words: DataFrame, totals: DataFrame, keep_percent: int = 100) -> DataFrame:
    """(lang, words, a, l, r, n, score) of the candidates that no longer one stands for.

    `phrases` (words, a), `words` (lang, print, n) and `totals` (lang, n) are counts.
    """
    size = F.size("words")
    counts = phrases.unionByName(words.select(F.array("print").alias("words"), F.col("n").alias("a"))).select(F.col("words").alias("part"), F.col("a").alias("part_a"))
    # The path through a node's heaviest edge, on either side.
    longer = phrases.where(size > 2).select(
        F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"), F.col("a").alias("longer_a")
    )
    compacted = longer.groupBy("words").agg(F.max("longer_a").alias("longer_a"))
    gone = 100 * F.col("longer_a").cast("decimal(19,0)") >= keep_percent * _exact("a")
    kept = phrases.join(compacted, "words", "left").where(~F.coalesce(gone, F.lit(False))).select("words", "a")
    cut = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.withColumns({"head": F.slice("words", F.lit(1), F.col("k")), "rest": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    left = counts.select(F.col("part").alias("head"), F.col("part_a").alias("l"))
    right = counts.select(F.col("part").alias("rest"), F.col("part_a").alias("r"))
    both = cut.join(left, "head").join(right, "rest")
    own = words.select(F.col("print").alias("first_print"), "lang").join(totals, "lang")
    both = both.withColumn("first_print", F.col("words")[0]).join(own, "first_print")
    over = F.lit(1000).cast("decimal(4,0)") * _exact("a").cast("decimal(15,0)") * _exact("n")
    score = F.call_function("div", over, _exact("l") * _exact("r"))
    best = both.withColumn("score", score).groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "words", "a", "best.l", "best.r", "n", "best.score")


def mine_phrases(documents: DataFrame, least: int = 100, top: int | None = 2000, keep_percent: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's collocations, best first.

    a, l and r count the phrase and both parts at its lowest-scoring cut, n the language's words.
    """
    lang = F.coalesce("lang", F.lit("und"))
    texts = documents.select("text", lang.alias("lang"), F.xxhash64(lang).alias("lang_key"))
    counted = map_batches(texts, "kind int, lang string, print bigint, word string, n bigint", _counted)
    counted = counted.groupBy("kind", "lang", "print", "word").agg(F.sum("n").alias("n"))
    with Scratch(documents.sparkSession) as scratch:
        known = scratch.keep(counted.where((F.col("kind") != WORD) | (F.col("n") >= least)))
        words = known.where(F.col("kind") == WORD).select("lang", "print", "word", "n")
        totals = known.where(F.col("kind") == TOTAL).select("lang", "n")
        everything = totals.agg(F.sum("n")).first()[0] or 0
        common = known.where((F.col("kind") == PREFIX) & (F.col("n") * STRIDE * HOT_SHARE > everything)).select("print").collect()
        hot = np.sort(np.array([r[0] for r in common], np.int64).view(np.uint64))
        shared = documents.sparkSession.sparkContext.broadcast(_Shared(frequent_filter(words), common_words(words), hot))
        rows = _edge_rows(texts, shared, max(1, -(-everything // GROUP_WORDS)))
        phrases = scratch.keep(_phrase_counts(rows, shared, least))
        scored = scored_phrases(phrases, words, totals, keep_percent)
        if top is not None:  # ties at the limit stay until texts decide
            best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
            scored = scored.withColumn("rank", F.rank().over(best_first)).where(F.col("rank") <= top).drop("rank")
        scored = scratch.keep(scored)
        each = scored.select("words", F.posexplode("words").alias("place", "print"))
        spelt = each.join(words.select("print", "word"), "print").groupBy("words").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelt"))
        phrase = F.array_join(F.transform("spelt", lambda s: s["word"]), " ")
        final = scored.join(spelt.select("words", phrase.alias("phrase")), "words")
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = final.withColumn("rank", F.row_number().over(order).cast("bigint"))
        if top is not None:
            ranked = ranked.where(F.col("rank") <= top)
        return materialize(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
