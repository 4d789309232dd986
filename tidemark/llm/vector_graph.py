"""Embedding near-duplicates through a robust-pruned flat graph.

Equal vectors are one class. Classes are dealt to the shards of all cluster centres that are nearly
as near as the nearest one (MARGIN), and of the PROBES nearest, so shards overlap; centres are fitted on a bounded sample (FIT_ROWS vectors, chosen by
hash), every class is indexed. Where the table is so large that shards overfill, they are cut by centres of their own. A shard with more than BLOCK_ROWS members is dealt to blocks by
hash. In each block a graph is built by beam search and robust pruning, and the adjacency lists that
a class gets in its shards are united. Then every pair of blocks of a shard is one task: the members
of either block search the other's graph from its medoid, the search grows over the graph as
long as it finds vectors in range, and what it finds is verified with the cosine in double precision.
So a group of near copies of any size is searched in tasks of bounded size. A search does not leave its
shard: edges of the united lists to other blocks are not followed, and a pair without a common shard is not found.

A task counts, for each class, the linked vectors, and sends a spanning forest of its links; pairs
are never rows. A pair that shares several shards counts in the first of them.

Recall is audited: slices of some AUDIT_ROWS classes, chosen by hash, are compared with all vectors until they
hold AUDIT_LINKED classes with links (or AUDIT_SLICES slices or the table are used up). If the linked classes among
them found less than RECALL of their linked classes on average, the search is repeated with twice
the margin; after TRIES tries it raises below LEAST_RECALL. The result says what was found. Without any audited
link the recall is 1.

Defined cases: vectors that are null, empty, zero, or have null or non-finite components link with
nothing; vectors of different lengths do not link; rows with one id and different vectors are searched
separately; null ids are kept and are no representative unless their component has no other id;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import mix
from tidemark.llm.components import connected_components
from tidemark.plans.materialize import materialize

COSINE = 0.95
SLACK = 0.05  # the search walks on through vectors that miss the range by so much
FIT_ROWS, SHARD_ROWS, BLOCK_ROWS, ROUNDS = 20_000, 1024, 2048, 6
DEGREE, BEAM, WIDTH, ALPHA, INCOMING = 24, 32, 4, 1.2, 32
BATCH = 128
PROBES, MARGIN, TRIES = 2, 1.0, 3
SPLIT_ROWS, GROUP_ROWS = 8 * SHARD_ROWS, 1 << 14
AUDIT_ROWS, AUDIT_SLICES, AUDIT_LINKED = 4000, 50, 200
RECALL, LEAST_RECALL = 0.99, 0.9  # what a try should reach, and what the last one has to


def beam_search(graph: np.ndarray, x: np.ndarray, queries: np.ndarray, start: int, size: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes that a greedy beam ends with, and their distances (1 - cosine)."""
    m, degree = len(queries), graph.shape[1]
    beam = np.full((m, size), -1)
    far = np.full((m, size), np.inf, np.float32)
    done = np.ones((m, size), bool)
    seen = np.zeros((m, len(x)), bool)
    beam[:, 0], far[:, 0], done[:, 0], seen[:, start] = start, 1 - queries @ x[start], False, True
    width = min(WIDTH, size)
    while True:
        open_ = np.where(done, np.inf, far)
        row = np.flatnonzero(np.isfinite(open_.min(1)))
        if not row.size:
            return beam, far
        pick = np.argpartition(open_[row], width - 1, 1)[:, :width]
        real = np.isfinite(np.take_along_axis(open_[row], pick, 1))
        done[row[:, None], pick] = True
        near = graph[np.take_along_axis(beam[row], pick, 1)]
        near[~real] = -1
        near = near.reshape(len(row), width * degree)
        # The same node may come from two of the expanded ones; it is kept once.
        near = np.sort(near, 1)
        new = near >= 0
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        new &= ~seen[row[:, None], near]
        r, c = np.nonzero(new)
        node = near[r, c]
        seen[row[r], node] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[r, c] = 1 - np.einsum("ij,ij->i", x[node], queries[row[r]])
        both, ids = np.concatenate([far[row], d], 1), np.concatenate([beam[row], near], 1)
        old = np.concatenate([done[row], np.zeros(near.shape, bool)], 1)
        best = np.argpartition(both, size - 1, 1)[:, :size]
        far[row] = np.take_along_axis(both, best, 1)
        beam[row] = np.where(np.isfinite(far[row]), np.take_along_axis(ids, best, 1), -1)
        done[row] = np.take_along_axis(old, best, 1) | ~np.isfinite(far[row])


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Out-neighbours of the nodes `own`: the nearest candidate, then again the nearest of those
    that no chosen one is closer to by the factor ALPHA."""
    valid = (candidates >= 0) & (candidates != own[:, None])
    points = x[np.maximum(candidates, 0)]
    away = np.sqrt(np.maximum(2 - 2 * np.einsum("ijk,ik->ij", points, x[own]), 0))
    between = np.sqrt(np.maximum(2 - 2 * points @ points.transpose(0, 2, 1), 0))
    out, row = np.full((len(own), degree), -1), np.arange(len(own))
    for slot in range(degree):
        left = np.where(valid, away, np.inf)
        pick = left.argmin(1)
        some = np.isfinite(left[row, pick])
        if not some.any():
            break
        out[some, slot] = candidates[row, pick][some]
        valid &= ~((ALPHA * between[row, pick] <= away) & some[:, None])
        valid[row, pick] = False
    return out


def build_graph(x: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """(out-neighbours of every node, the medoid)."""
    n = len(x)
    degree = min(DEGREE, max(1, n - 1))
    rng = np.random.default_rng(seed)
    graph = rng.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    center = medoid(x)
    order = rng.permutation(n)
    for lo in range(0, n, BATCH):
        batch = order[lo : lo + BATCH]
        found, _ = beam_search(graph, x, x[batch], center)
        graph[batch] = robust_prune(x, batch, np.concatenate([found, graph[batch]], 1), degree)
        source, target = np.repeat(batch, degree), graph[batch].ravel()
        real = target >= 0
        source, target = source[real], target[real]
        near = np.lexsort((-np.einsum("ij,ij->i", x[source], x[target]), target))
        source, target = source[near], target[near]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        incoming = np.full((len(nodes), INCOMING), -1)
        inside = place < INCOMING
        incoming[np.repeat(np.arange(len(nodes)), count)[inside], place[inside]] = source[inside]
        for part in range(0, len(nodes), BATCH):
            own = nodes[part : part + BATCH]
            graph[own] = robust_prune(x, own, np.concatenate([graph[own], incoming[part : part + BATCH]], 1), degree)
    return graph, center


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def range_search(graph: np.ndarray, x: np.ndarray, queries: np.ndarray, start: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of the nodes with at least `cosine`, as far as the graph leads to them."""
    beam, far = beam_search(graph, x, queries, start)
    seen = np.zeros((len(queries), len(x)), bool)
    row, column = np.nonzero(beam >= 0)
    node = beam[row, column]
    seen[row, node] = True
    near = 1 - far[row, column]
    hits = [(row[near >= cosine], node[near >= cosine])]
    row, node = row[near >= cosine - SLACK], node[near >= cosine - SLACK]
    while row.size:
        later = []
        for lo in range(0, len(row), 4096):
            r = np.repeat(row[lo : lo + 4096], graph.shape[1])
            c = graph[node[lo : lo + 4096]].ravel()
            new = c >= 0
            new[new] = ~seen[r[new], c[new]]
            key = np.unique(r[new] * len(x) + c[new])
            r, c = key // len(x), key % len(x)
            seen[r, c] = True
            near = np.einsum("ij,ij->i", x[c], queries[r])
            hits.append((r[near >= cosine], c[near >= cosine]))
            later.append((r[near >= cosine - SLACK], c[near >= cosine - SLACK]))
        row, node = (np.concatenate(p) for p in zip(*later, strict=True))
    return tuple(np.concatenate(p) for p in zip(*hits, strict=True))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _unit_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, class, unit): the vector's fingerprint and its direction in double precision, both null for
    vectors that cannot link."""
    hashed = vectors.select("vec_id", F.xxhash64("embedding").alias("class"), "embedding")

    def work(batches):
        for b in batches:
            column = field(b, "embedding")
            lists = column.values.cast(pa.float64())
            values = np.array(lists.fill_null(np.nan), np.float64)
            edge = np.array(column.offsets, np.int64)
            size = np.where(np.array(column.is_valid()), np.diff(edge), 0)
            units: list[bytes | None] = [None] * len(column)
            for length in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == length)
                x = values[edge[rows][:, None] + np.arange(length)]
                # Scaled by the largest component first, so that squares neither overflow nor vanish.
                top = np.abs(x).max(axis=1)
                good = np.isfinite(top) & (top > 0)
                x = x[good] / top[good, None]
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                for row, unit in zip(rows[good].tolist(), x, strict=True):
                    units[row] = unit.tobytes()
            out = pa.array(units, pa.binary())
            classes = pc.if_else(out.is_valid(), field(b, "class"), pa.scalar(None, pa.int64()))
            yield pa.RecordBatch.from_arrays([field(b, "vec_id").cast(pa.int64()), classes, out], ["vec_id", "class", "unit"])

    return map_batches(hashed, "vec_id bigint, class bigint, unit binary", work)


def fit_centres(classes: DataFrame) -> dict[int, np.ndarray]:
    """Cluster centres by bytes of a vector: k-means on at most FIT_ROWS directions chosen by hash."""
    rows = classes.count()
    every = max(1, rows // (2 * FIT_ROWS))
    sample = classes.where(F.pmod("class", F.lit(every)) == 0).orderBy("class").limit(FIT_ROWS)
    by_length: dict[int, list[bytes]] = {}
    for (unit,) in sorted(sample.select("unit").collect()):
        by_length.setdefault(len(unit), []).append(bytes(unit))
    centres = {}
    total = sum(map(len, by_length.values()))
    for length, units in by_length.items():
        x = np.frombuffer(b"".join(units)).reshape(len(units), -1)
        k = max(1, min(-(-rows * len(units) // (total * SHARD_ROWS)), -(-len(units) // 8)))
        own = x[np.random.default_rng(k).choice(len(x), k, replace=False)]
        for _ in range(ROUNDS):
            best = np.concatenate([(x[i : i + 1024] @ own.T).argmax(1) for i in range(0, len(x), 1024)])
            sums = np.zeros_like(own)
            np.add.at(sums, best, x)
            size = np.sqrt((sums**2).sum(1))
            own = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], own)
        centres[length] = own
    return centres


def _nearest_shards(x: np.ndarray, centres: np.ndarray, margin: float, first: int) -> list[list[int]]:
    """For each row the centres whose cosine is within `margin` of the best one, and the PROBES best at least."""
    near = x @ centres.T
    order = np.argsort(-near, axis=1, kind="stable")
    ranked = np.take_along_axis(near, order, axis=1)
    count = np.maximum((ranked >= ranked[:, :1] - margin).sum(axis=1), min(PROBES, len(centres)))
    return [sorted((row[:n] + first).tolist()) for row, n in zip(order, count.tolist(), strict=True)]


def _placed(classes: DataFrame, centres: dict[int, np.ndarray], margin: float, cosine: float, block_rows: int) -> DataFrame:
    """(class, copies, unit, shards, shard, block): a row for each shard of a class.

    Two vectors in range are at most a chord of sqrt(2 - 2 cosine) apart, so their cosines with a centre differ
    by that at most, and by a share of 1 / sqrt(components) of it where directions are scattered. `margin`
    counts in such shares: a vector near to several centres goes to all of them, one inside a cluster to few.
    """
    order = {length: i for i, length in enumerate(sorted(centres))}

    def work(batches):
        for b in batches:
            units = field(b, "unit").to_pylist()
            shards: list[list[int]] = [[-len(u)] for u in units]  # a length that the sample has not: one shard for it
            for length in {len(u) for u in units} & set(centres):
                at = [i for i, u in enumerate(units) if len(u) == length]
                reach = margin * np.sqrt((2 - 2 * cosine) / (length // 8))
                for lo in range(0, len(at), BATCH):
                    own = at[lo : lo + BATCH]
                    x = np.frombuffer(b"".join(units[i] for i in own)).reshape(len(own), -1)
                    for i, found in zip(own, _nearest_shards(x, centres[length], reach, order[length] << 40), strict=True):
                        shards[i] = found
            yield pa.RecordBatch.from_arrays([*[field(b, n) for n in ("class", "copies", "unit")], pa.array(shards, pa.list_(pa.int64()))], ["class", "copies", "unit", "shards"])

    schema = "class bigint, copies bigint, unit binary, shards array<bigint>"
    placed = materialize(map_batches(classes.select("class", "copies", "unit"), schema, work))
    each = placed.withColumn("shard", F.explode("shards"))
    counts = materialize(each.groupBy("shard").agg(F.count(F.lit(1)).alias("n")))
    if counts.where(F.col("n") > SPLIT_ROWS).head(1):
        placed = materialize(_split(placed, each, counts, margin, cosine))
        each = placed.withColumn("shard", F.explode("shards"))
    blocks = each.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    each = each.join(materialize(blocks), "shard")
    return each.withColumn("block", F.pmod(F.xxhash64("class", "shard"), F.col("blocks")).cast("int"))


def _split(placed: DataFrame, each: DataFrame, counts: DataFrame, margin: float, cosine: float) -> DataFrame:
    """`placed` with shards above SPLIT_ROWS cut into about SHARD_ROWS members.

    Members chosen by hash are the centres of a shard's parts, and members go to parts by the same rule as vectors
    go to shards. So the number of shards is not bounded by the sample that the first centres come from. A shard is
    cut in tasks of GROUP_ROWS members, each of which gets the shard's centres, a thousandth of its members.
    """
    large = counts.where(F.col("n") > SPLIT_ROWS).select(
        "shard", "n", F.ceil(F.col("n") / SHARD_ROWS).alias("parts"), F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("groups")
    )
    members = each.select("class", "unit", "shard").join(large, "shard")
    place = F.pmod(F.xxhash64("class", "shard", F.lit("part")), F.col("n"))
    centres = members.where(place < 2 * F.col("parts")).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    dealt = members.withColumn("group", F.pmod(F.xxhash64("class", "shard"), F.col("groups")).cast("int"))
    columns = ["shard", "group", "class", "unit"]
    both = dealt.select(*columns, F.lit(False).alias("centre")).unionByName(centres.select(*columns, F.lit(True).alias("centre")))

    def work(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        is_centre = np.array(table["centre"])
        found = []
        for length in {len(u) for u in table["unit"].to_pylist()}:
            of_length = np.array(pc.equal(pc.binary_length(table["unit"]), length))
            centres = table.filter(pa.array(is_centre & of_length)).sort_by("class")
            own = table.filter(pa.array(~is_centre & of_length))
            if not centres.num_rows:  # hardly ever: the shard stays whole
                found.append((own["class"].combine_chunks(), [[shard]] * own.num_rows))
                continue
            reach = margin * np.sqrt((2 - 2 * cosine) / (length // 8))
            names = mix(np.array(centres["class"], np.int64).view(np.uint64) ^ mix(np.array([shard], np.int64).view(np.uint64)))
            names = (names >> np.uint64(1)).astype(np.int64)  # a part's number is made of its shard's and its centre's
            x, c = _matrix(own["unit"]), _matrix(centres["unit"])
            at = [a for lo in range(0, len(x), BATCH) for a in _nearest_shards(x[lo : lo + BATCH], c, reach, 0)]
            found.append((own["class"].combine_chunks(), [names[a].tolist() for a in at]))
        return pa.table({"class": pa.concat_arrays([f[0] for f in found]), "parts": pa.array([p for f in found for p in f[1]], pa.list_(pa.int64()))})

    cut = both.groupBy("shard", "group").applyInArrow(work, "class bigint, parts array<bigint>")
    whole = each.join(large.select("shard"), "shard", "left_anti").select("class", F.array("shard").alias("parts"))
    lists = cut.unionByName(whole).groupBy("class").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("parts")))).alias("shards"))
    return placed.drop("shards").join(lists, "class").select("class", "copies", "unit", "shards")


def _adjacency(placed: DataFrame) -> DataFrame:
    """(class, near): a class's out-neighbours, united over its shards."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        classes = np.array(table["class"])
        graph, _ = build_graph(_matrix(table["unit"]).astype(np.float32))
        near = [classes[g[g >= 0]] for g in graph]
        return pa.table({"class": classes, "near": pa.array(near, pa.list_(pa.int64()))})

    lists = placed.select("shard", "block", "class", "unit").groupBy("shard", "block").applyInArrow(work, "class bigint, near array<bigint>")
    return lists.groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a and b; `root` keeps the smallest index of each tree."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def _local_graph(classes: np.ndarray, near: list) -> np.ndarray:
    """Adjacency lists as rows of places in `classes` (ascending); other classes are left out."""
    size = np.array([len(n) for n in near])
    flat = np.concatenate(near) if size.sum() else np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(classes, flat), len(classes) - 1)
    at = np.where(classes[at] == flat, at, -1)
    graph = np.full((len(near), max(1, int(size.max(initial=0)))), -1)
    row = np.repeat(np.arange(len(near)), size)
    graph[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = at
    return graph


def search_blocks(table: pa.Table, first: int, second: int, shard: int, cosine: float) -> pa.Table:
    """Links between two blocks of a shard (or inside one): for each class the number of vectors and of classes
    that it links with, and the smallest class of its local component."""
    sides = []
    for block in dict.fromkeys((first, second)):
        own = table.filter(pa.array(np.array(table["block"]) == block)).sort_by("class")
        if not own.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("class", "links", "linked", "root")})
        classes, exact = np.array(own["class"]), _matrix(own["unit"])
        graph = _local_graph(classes, [np.array(n, np.int64) for n in own["near"].to_pylist()])
        shards = own["shards"].to_pylist()
        width = max(map(len, shards))
        shards = np.array([s + [-1] * (width - len(s)) for s in shards])
        sides.append((classes, np.array(own["copies"]), exact, exact.astype(np.float32), graph, shards))
    one, two = sides[0], sides[-1]
    same = len(sides) == 1
    floor = cosine - 1e-4  # single precision while searching
    linked = np.zeros((len(one[0]), len(two[0])), bool)
    for queries, target, flip in [(one, two, False)] if same else [(one, two, False), (two, one, True)]:
        start = medoid(target[3])
        for lo in range(0, len(queries[0]), BATCH):
            q, node = range_search(target[4], target[3], queries[3][lo : lo + BATCH], start, floor)
            linked[(node, q + lo) if flip else (q + lo, node)] = True
    if same:
        linked |= linked.T
    classes = one[0] if same else np.concatenate([one[0], two[0]])
    order = np.argsort(classes, kind="stable")
    place = np.empty(len(classes), np.int64)
    place[order] = np.arange(len(classes))
    shift = 0 if same else len(one[0])
    links, partners, root = np.zeros(len(classes), np.int64), np.zeros(len(classes), np.int64), np.arange(len(classes))
    for lo in range(0, len(one[0]), BATCH):
        a, b = np.nonzero(linked[lo : lo + BATCH])
        a = a + lo
        if same:
            a, b = a[a != b], b[a != b]
        for cut in range(0, len(a), 1 << 16):
            i, j = a[cut : cut + (1 << 16)], b[cut : cut + (1 << 16)]
            good = np.einsum("ij,ij->i", one[2][i], two[2][j]) >= cosine
            i, j = i[good], j[good]
            _union(root, place[i], place[j + shift])
            common = (one[5][i][:, :, None] == two[5][j][:, None, :]) & (one[5][i][:, :, None] >= 0)
            lowest = np.where(common.any(2), one[5][i], np.iinfo(np.int64).max).min(1)
            counted = (lowest == shard) | (shard < 0)  # a shard for a length of its own has no number
            i, j = i[counted], j[counted]
            links += np.bincount(i, two[1][j], len(links)).astype(np.int64)
            partners += np.bincount(i, minlength=len(links))
            if not same:
                links += np.bincount(j + shift, one[1][i], len(links)).astype(np.int64)
                partners += np.bincount(j + shift, minlength=len(links))
    return pa.table({"class": classes, "links": links, "linked": partners, "root": classes[order][root[place]]})


def _searched(placed: DataFrame, near: DataFrame, cosine: float) -> DataFrame:
    """(class, links, linked, root) from all tasks; a class is in many, each with a share of its links."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.join(near, "class").select("class", "copies", "unit", "shards", "shard", "block", "near", other)
    pairs = pairs.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})

    def work(key: tuple, table: pa.Table) -> pa.Table:
        shard, first, second = (k.as_py() for k in key)
        return search_blocks(table, first, second, shard, cosine)

    grouped = pairs.groupBy("shard", "first", "second")
    return materialize(grouped.applyInArrow(work, "class bigint, links bigint, linked bigint, root bigint"))


def _exact_links(classes: DataFrame, asked: list[tuple[int, bytes]], cosine: float) -> list[tuple[int, int]]:
    """(class, number of classes that it links with) of those among `asked` that link, by brute force."""
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for length in {len(u) for _, u in asked}:
        own = [a for a in asked if len(a[1]) == length]
        q = np.frombuffer(b"".join(u for _, u in own)).reshape(len(own), -1)
        by_length[length] = np.array([c for c, _ in own], np.int64), q, q.astype(np.float32)

    def work(batches):
        for b in batches:
            names, units = np.array(field(b, "class")), field(b, "unit").to_pylist()
            for length in {len(u) for u in units} & set(by_length):
                ids, q, single = by_length[length]
                at = np.array([i for i, u in enumerate(units) if len(u) == length])
                x = np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), -1)
                row, column = np.nonzero(single @ x.astype(np.float32).T >= cosine - 1e-4)
                found = np.zeros(len(ids), np.int64)
                for cut in range(0, len(row), 1 << 16):
                    i, j = row[cut : cut + (1 << 16)], column[cut : cut + (1 << 16)]
                    good = (np.einsum("ij,ij->i", q[i], x[j]) >= cosine) & (ids[i] != names[at[j]])
                    found += np.bincount(i[good], minlength=len(ids))
                some = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(found[some])], ["class", "exact"])

    exact = map_batches(classes.select("class", "unit"), "class bigint, exact bigint", work)
    return [tuple(r) for r in exact.groupBy("class").agg(F.sum("exact")).collect()]


def audit_sample(classes: DataFrame, cosine: float) -> list[tuple[int, int]]:
    """(class, number of classes that it links with) of audited classes that have links.

    Classes are taken in slices by hash, whatever the shards, until AUDIT_LINKED of them have links."""
    slices = max(1, -(-classes.count() // AUDIT_ROWS))
    linked: list[tuple[int, int]] = []
    for part in range(min(slices, AUDIT_SLICES)):
        asked = classes.where(F.pmod(F.xxhash64("class"), F.lit(slices)) == part).select("class", "unit").collect()
        linked += _exact_links(classes, [(c, bytes(u)) for c, u in asked], cosine)
        if len(linked) >= AUDIT_LINKED:
            break
    return linked


def audit(sample: list[tuple[int, int]], links: DataFrame) -> float:
    """The share of its linked classes that an audited class found, on average; 1 if none has any."""
    if not sample:
        return 1.0
    exact = links.sparkSession.createDataFrame(sample, "class bigint, exact bigint")
    # Links are exact where found, so a class cannot have more than brute force counts.
    share = F.coalesce("linked", F.lit(0)) / F.col("exact")
    return exact.join(links, "class", "left").agg(F.avg(share)).first()[0]


def link_vectors(vectors: DataFrame, cosine: float = COSINE, margin: float = MARGIN) -> DataFrame:
    """vec_id, n_links, component_id, kept and recall (of the audit) for every row of vectors (vec_id, embedding)."""
    rows = materialize(_unit_rows(vectors.select("vec_id", "embedding")))
    classes = rows.where("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("copies"), F.any_value("unit").alias("unit"), F.min("vec_id").alias("vec_id")
    )
    classes = materialize(classes)
    centres, sample = fit_centres(classes), audit_sample(classes, cosine)
    for tries in range(TRIES):
        placed = materialize(_placed(classes, centres, margin * 2**tries, cosine, BLOCK_ROWS))
        found = _searched(placed, materialize(_adjacency(placed)), cosine)
        links = materialize(found.groupBy("class").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked")))
        recall = audit(sample, links)
        if recall >= RECALL:
            break
    if recall < LEAST_RECALL:
        raise RuntimeError(f"{TRIES} tries found {recall:.3f} of the audited links")
    groups = connected_components(found.select("class", "root").distinct(), "class", "root").withColumnRenamed("node", "class")
    named = classes.join(links.drop("linked"), "class").join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = materialize(named.select("class", "copies", "links", "vec_id", "component"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "component").select("class", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "class").join(named, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"), own.eqNullSafe(F.col("vec_id")).alias("kept"), F.lit(recall).alias("recall")
    )
