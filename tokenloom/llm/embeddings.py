"""Near-duplicate vectors by a robust-pruned flat graph.

1. Vectors are dealt into regions around centroids learnt from a bounded sample; a vector goes into every region whose
   centroid is nearly as similar as its best one, so regions overlap.
2. In a region, overlapping cluster shards of at most ``SHARD`` vectors are cut. In a shard a vector's candidates are its
   nearest ones and some drawn from the rest, and robust pruning leaves edges of different directions and lengths. The
   adjacency lists of all shards, both ways round, are united into one flat graph.
3. Every vector is searched for from the medoids of the shards: the best vertex not yet expanded is expanded next, until
   the vector itself is met; and every vertex within ``WIDER`` times the distance asked for is expanded as well, until that
   range holds no new one.
4. Pairs found are verified in double precision. A pair that meets in several regions counts in the first they share.
5. ``audit`` compares a sample of vectors with all others by brute force; where fewer than ``RECALL`` of the links were
   found, the search is done again with twice the overlap.

No pairs leave a task: a region sends each vertex's number of links and the smallest vertex it hangs together with. Equal
vectors are one vertex with a number of copies. A region that grows past ``PORTION`` vertices is cut into portions, and
every two portions are searched together, so a task never holds more than two.

Edge cases: a vector that is null, empty, zero, or holds a null or non-finite component links with nothing; vectors of
different lengths don't link; repeated rows are copies of each other; a null id is returned as it is and ignored where the
smallest id is sought; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import ragged, stored
from tokenloom.llm.graph import components

LEAST = 0.95
SAMPLE_ROWS = 16_384
REGION, PORTION = 8192, 24_576
OVERLAP, SLACK = 4, 0.15
SHARD, SHARD_OVERLAP = 1024, 2
NEAREST, DRAWN, DEGREE, ALPHA = 48, 16, 24, 1.2
WIDER = 1.3
AUDIT_ROWS, RECALL, ROUNDS = 1024, 0.99, 3
QUERIES, BLOCK = 1 << 22, 128
ROWS = "vec_id long, packed binary"
DEALT = "region int, regions array<int>, node long, many long, packed binary"
LINKED = "node long, links long, root long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null where a vector can't be compared."""
    for batch in batches:
        lists = batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        # A null component is not a number, and a negative zero is a zero.
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        row = np.repeat(np.arange(len(sizes)), sizes)
        odd = np.bincount(row, weights=~np.isfinite(values), minlength=len(sizes)) > 0
        empty = np.bincount(row, weights=values != 0, minlength=len(sizes)) == 0
        offsets = np.concatenate([[0], np.cumsum(sizes)]) * 8
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
        packed = pc.if_else(pa.array(odd | empty), pa.scalar(None, pa.large_binary()), packed).cast(pa.binary())
        yield pa.record_batch([batch.column(0), packed], ["vec_id", "packed"])


def units(packed: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(x: np.ndarray, number: int, turns: int = 4) -> np.ndarray:
    """``number`` directions that the rows of x gather round."""
    draw = np.random.default_rng(len(x))
    out = x[draw.permutation(len(x))[:number]]
    for _ in range(turns):
        nearest = (x @ out.T).argmax(1)
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, x)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        out = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), out)
    return out


def nearest_few(x: np.ndarray, centres: np.ndarray, overlap: int, slack: float) -> np.ndarray:
    """Of each row, the numbers of its most similar centres, best first; -1 where one is no longer within the slack."""
    alike = x @ centres.T
    few = min(overlap, alike.shape[1])
    at = np.argsort(-alike, axis=1, kind="stable")[:, :few]
    value = np.take_along_axis(alike, at, 1)
    return np.where(value >= value[:, :1] - slack, at, -1)


def _deal(centres: dict[int, tuple[int, np.ndarray]], overlap: int, slack: float):
    """Vertices with the regions they belong to; vectors of a length that the sample lacks share one region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(2).to_pylist()
            length = np.array([len(p) for p in packed], np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                if int(size) in centres:
                    first, table = centres[int(size)]
                    found = nearest_few(units([packed[r] for r in rows]), table, overlap, slack)
                    found = np.where(found >= 0, found + first, -1)
                else:
                    found = np.full((len(rows), 1), -2 - size // 8)
                used = found != -1
                number = used.sum(1)
                regions = pa.array([f[u].tolist() for f, u in zip(found, used)], pa.list_(pa.int32()))
                at = pa.array(np.repeat(np.arange(len(rows)), number))
                mine = batch.take(pa.array(rows)).take(at)
                columns = [pa.array(found[used].astype(np.int32)), regions.take(at), mine.column(0), mine.column(1), mine.column(2)]
                yield pa.record_batch(columns, ["region", "regions", "node", "many", "packed"])

    return run


def robust_prune(alike: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to): of each row's candidates, sorted by nearness, those no chosen one is ``alpha`` times nearer to."""
    distance = lambda s: np.sqrt(np.maximum(0, 2 - 2 * s))
    rows = np.arange(len(candidates))
    far = distance(alike[rows[:, None], candidates])
    alive = candidates != rows[:, None]
    starts, ends = [], []
    for _ in range(degree):
        going = alive.any(1)
        if not going.any():
            break
        rows, candidates, far, alive = rows[going], candidates[going], far[going], alive[going]
        first = alive.argmax(1)
        chosen = candidates[np.arange(len(rows)), first]
        starts.append(rows)
        ends.append(chosen)
        alive[np.arange(len(rows)), first] = False
        alive &= (candidates != chosen[:, None]) & (alpha * distance(alike[chosen[:, None], candidates]) > far)
    return np.concatenate(starts or [rows[:0]]), np.concatenate(ends or [rows[:0]])


def cut_shards(x: np.ndarray) -> list[np.ndarray]:
    """Overlapping clusters of the rows, none above ``SHARD``; a larger one is cut by chance."""
    if len(x) <= SHARD:
        return [np.arange(len(x))]
    draw = np.random.default_rng(7)
    number = -(-2 * SHARD_OVERLAP * len(x) // SHARD)
    few = nearest_few(x, centroids(x[draw.permutation(len(x))[: 16 * number]], number), SHARD_OVERLAP, 2.0)
    row, centre = np.repeat(np.arange(len(x)), few.shape[1]), few.ravel()
    order = np.argsort(centre, kind="stable")
    out = []
    for members in np.split(row[order], np.cumsum(np.bincount(centre, minlength=number))[:-1]):
        if len(members):
            out += np.array_split(draw.permutation(members), -(-len(members) // SHARD))
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values, each once; ``np.unique`` hashes them first, which takes longer."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]][: len(values)]]


def flat_graph(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The united adjacency lists as offsets and neighbours, and the medoids of the shards."""
    draw = np.random.default_rng(11)
    edges, medoids = [np.zeros(0, np.int64)], []
    for members in cut_shards(x):
        mine = x[members]
        alike = mine @ mine.T
        medoids.append(members[alike.sum(1).argmax()])
        few = min(NEAREST, len(members))
        near = np.argpartition(-alike, few - 1, axis=1)[:, :few]
        drawn = draw.integers(0, len(members), (len(members), DRAWN))
        both = np.concatenate([near, drawn], 1)
        both = np.take_along_axis(both, np.argsort(-np.take_along_axis(alike, both, 1), axis=1, kind="stable"), 1)
        start, end = robust_prune(alike, both)
        start, end = members[start], members[end]
        edges.append(distinct(np.r_[start * len(x) + end, end * len(x) + start]))
    # The medoids are joined in a ring, so that none is cut off from the others.
    medoids = np.unique(medoids)
    ring = np.roll(medoids, 1)
    edges.append(np.r_[medoids * len(x) + ring, ring * len(x) + medoids])
    joined = distinct(np.concatenate(edges))
    start, end = joined // len(x), joined % len(x)
    start, end = start[start != end], end[start != end]
    return np.searchsorted(start, np.arange(len(x) + 1)), end, medoids


def range_search(x: np.ndarray, graph: tuple[np.ndarray, np.ndarray, np.ndarray], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, vertex) at a similarity of ``least`` and more, for every row as a query, some queries at a time.

    The greatest similarity of every ``BLOCK`` vertices is kept, so that a step doesn't read all vertices for the best one.
    """
    offsets, ends, medoids = graph
    n = len(x)
    wide = 1 - WIDER**2 * (1 - least)
    blocks = -(-n // BLOCK)
    n_all, step = blocks * BLOCK, max(1, QUERIES // n)
    for low in range(0, n, step):
        query = np.arange(low, min(low + step, n))
        seen = np.zeros(len(query) * n_all, bool)
        # Similarity of the vertices met and not yet expanded, and the greatest one of each block.
        waiting = np.full(len(query) * n_all, -2, np.float32)
        best = np.full(len(query) * blocks, -2, np.float32)
        in_blocks, block_best = waiting.reshape(-1, BLOCK), best.reshape(-1, blocks)

        def meet(q: np.ndarray, v: np.ndarray, place: np.ndarray, alike: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            seen[place], waiting[place] = True, alike
            np.maximum.at(best, place // BLOCK, alike)
            inside = np.flatnonzero(alike >= wide)
            return q[inside], v[inside], alike[inside]

        q, v = np.repeat(np.arange(len(query)), len(medoids)), np.tile(medoids, len(query))
        fresh_q, fresh_v, alike = meet(q, v, q * n_all + v, (x[query] @ x[medoids].T).ravel())
        itself = np.arange(len(query)) * n_all + query
        while True:
            close = alike >= least
            yield query[fresh_q[close]], fresh_v[close]
            # What lies within the range is expanded at once, and of each query that has not met itself the best one.
            going = np.flatnonzero(~seen[itself])
            block = going * blocks + block_best[going].argmax(1)
            more = best[block] > -2
            going, block = going[more], block[more]
            top = block * BLOCK + in_blocks[block].argmax(1) - going * n_all
            q, v = np.r_[fresh_q, going], np.r_[fresh_v, top]
            if not len(q):
                break
            place = q * n_all + v
            waiting[place] = -2
            block = place // BLOCK
            best[block] = in_blocks[block].max(1)
            size = offsets[v + 1] - offsets[v]
            # A vertex has each neighbour once, so only queries with several vertices can meet one twice.
            once = np.repeat(np.bincount(q, minlength=len(query))[q] == 1, size)
            q, v = np.repeat(q, size), ends[np.repeat(offsets[v], size) + ragged(size)]
            place = q * n_all + v
            new = ~seen[place]
            place = np.r_[place[new & once], distinct(place[new & ~once])]
            q, v = place // n_all, place % n_all
            alike = np.empty(len(q), np.float32)
            for at in range(0, len(q), 1 << 18):
                some = slice(at, at + (1 << 18))
                alike[some] = np.einsum("ij,ij->i", x[query[q[some]]], x[v[some]])
            fresh_q, fresh_v, alike = meet(q, v, place, alike)


def lowest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row each row hangs together with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _region(least: float):
    """Links of one region, or of two portions of one: what each vertex adds, and the vertex it hangs together with."""

    def run(group: pa.Table) -> pa.Table:
        order = pc.sort_indices(group["node"])
        group = group.take(order).combine_chunks()
        node, many, own = (group[c].to_numpy() for c in ("node", "many", "own"))
        region, first, second = (group[c][0].as_py() for c in ("region", "first", "second"))
        lists = group["regions"].to_pylist()
        member = np.full((len(node), max(map(len, lists))), np.iinfo(np.int32).max, np.int64)
        for i, x in enumerate(lists):
            member[i, : len(x)] = x
        exact = units(group["packed"].to_pylist())
        rough = exact.astype(np.float32)
        n = len(node)
        links, kept, held = np.zeros(n, np.int64), [np.zeros(0, np.int64)], 0
        for q, v in range_search(rough, flat_graph(rough), least - 1e-4) if n > 1 else ():
            some = q != v
            kept.append(np.minimum(q, v)[some] * n + np.maximum(q, v)[some])
            held += len(kept[-1])
            if held > 1 << 23:
                kept = [distinct(np.concatenate(kept))]
                held = len(kept[0])
        pairs = distinct(np.concatenate(kept))
        good = np.zeros(len(pairs), bool)
        for low in range(0, len(pairs), 1 << 17):
            a, b = pairs[low : low + (1 << 17)] // n, pairs[low : low + (1 << 17)] % n
            shared = np.full(len(a), np.iinfo(np.int32).max)
            for k in range(member.shape[1]):
                has = (member[a, k][:, None] == member[b]).any(1)
                shared = np.where(has, np.minimum(shared, member[a, k]), shared)
            here = (shared == region) & ((first == second) | (own[a] != own[b]))
            good[low : low + len(a)] = here & (np.einsum("ij,ij->i", exact[a], exact[b]) >= least)
        a, b = pairs[good] // n, pairs[good] % n
        links += np.bincount(a, weights=many[b], minlength=n).astype(np.int64)
        links += np.bincount(b, weights=many[a], minlength=n).astype(np.int64)
        root = node[lowest_linked(n, a, b)]
        some = links > 0
        return pa.table([pa.array(node[some]), pa.array(links[some]), pa.array(root[some])], ["node", "links", "root"])

    return run


def _count_links(sample: list[tuple[int, bytes]], least: float):
    """Links of the sampled vertices with the rows of a batch, by brute force."""
    lengths = {len(p) for _, p in sample}
    tables = {size: (np.array([i for i, p in sample if len(p) == size]), units([p for _, p in sample if len(p) == size])) for size in lengths}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {size: np.zeros(len(ids), np.int64) for size, (ids, _) in tables.items()}
        for batch in batches:
            node, many, packed = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            length = np.array([len(p) for p in packed], np.int64)
            for size, (ids, table) in tables.items():
                rows = np.flatnonzero(length == size)
                if len(rows):
                    hit = (table @ units([packed[r] for r in rows]).T >= least) & (ids[:, None] != node[rows])
                    total[size] += hit @ many[rows]
        for size, (ids, _) in tables.items():
            yield pa.record_batch([pa.array(ids), pa.array(total[size])], ["node", "links"])

    return run


def audit(vertices: DataFrame, linked: DataFrame, least: float = LEAST, rows: int = AUDIT_ROWS) -> tuple[int, int]:
    """Links found and links there are, of a sample of ``rows`` vertices (smallest hash of the vertex)."""
    sample = [(r.node, bytes(r.packed)) for r in vertices.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(rows).select("node", "packed").collect()]
    if not sample:
        return 0, 0
    there = vertices.select("node", "many", "packed").mapInArrow(_count_links(sample, least), "node long, links long")
    there = there.groupBy("node").agg(F.sum("links").alias("links"))
    found = linked.groupBy("node").agg(F.sum("links").alias("found"))
    both = there.join(found, "node", "left").agg(F.sum(F.coalesce("found", F.lit(0))), F.sum("links")).first()
    return both[0], both[1]


def search(vertices: DataFrame, least: float = LEAST, overlap: int = OVERLAP, slack: float = SLACK) -> DataFrame:
    """node, links and root, a row for each region and vertex with links in it, of a table (node, many, packed)."""
    count = vertices.count()
    # A bounded sample; centroids only decide which vectors meet, and every vector is searched for.
    sample = [bytes(r.packed) for r in vertices.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("packed").collect()]
    by_size: dict[int, list[bytes]] = {}
    for packed in sample:
        by_size.setdefault(len(packed), []).append(packed)
    centres, first = {}, 0
    for size, some in sorted(by_size.items()):
        number = int(np.clip(-(-count * len(some) // (len(sample) * REGION)), 1, max(1, len(some) // 8)))
        centres[size] = (first, centroids(units(some), number))
        first += number
    dealt = stored(vertices.select("node", "many", "packed").mapInArrow(_deal(centres, overlap, slack), DEALT))
    sizes = dealt.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / PORTION).cast("int").alias("portions"))
    own = F.pmod(F.xxhash64("node", F.lit(5)), F.col("portions")).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("other")
    met = dealt.join(sizes, "region").select("*", own).select("*", other)
    met = met.withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
    columns = ["region", "first", "second", "own", "regions", "node", "many", "packed"]
    return met.select(*columns).groupBy("region", "first", "second").applyInArrow(_region(least), LINKED)


def groups(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    source = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = stored(source.mapInArrow(_pack, ROWS))
    classes = rows.where("packed is not null").groupBy("packed").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("many"))
    vertices = stored(classes.select(F.monotonically_increasing_id().alias("node"), "first", "many", "packed"))
    linked, overlap, slack = None, OVERLAP, SLACK
    for _ in range(ROUNDS):
        linked = stored(search(vertices, least, overlap, slack))
        found, there = audit(vertices, linked, least)
        if found >= RECALL * there:
            break
        overlap, slack = 2 * overlap, 2 * slack
    parts = components(linked.selectExpr("node as a", "root as b"))
    number = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = vertices.join(number, "node", "left").join(parts, "node", "left").select(
        "packed", "first", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(lowest, "component").select("packed", "n_links", "component_id")
    alone = F.col("packed").isNull()
    return (
        rows.join(known, "packed", "left")
        .select(
            "vec_id",
            F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
