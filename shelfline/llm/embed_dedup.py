"""Near-duplicate embeddings: spherical k-means cells, pruned cosine products of blocks, one vector of each group.

Equal vectors are one class first. Centroids are fitted on at most ``SAMPLE`` classes, chosen by the hash of their id; there is one
for every ``CELL`` classes, at most ``CENTROIDS``. Every class lives in the cell of its nearest centroid. Classes are packed cell by
cell in blocks of at most about ``BLOCK`` and ``BYTES``, one row each. Pairs of blocks are a Cartesian product that reads the packed table
again and again and shuffles nothing, so what is stored grows with the vectors alone.

In a pair of blocks, leaves (up to ``LEAF`` classes of one cell, about equally far from its centroid) are compared. Two vectors at the
threshold differ by an angle t. So a class can have a link in another leaf only if its angle to that leaf's centroid is less than t above the largest
angle found there, and only if it is within sin(t) of the border of both cells. Those left are compared by a few leading directions: their
product and that of the lengths of the rest bound the cosine from above. Those left then get the product in single precision and, where that is as near to the
threshold as it can err, in double precision. Each rule drops only what can't link, whatever the vectors, so the join is exact; evenly spread vectors still take
time that grows with the square. A block pair returns a count for each vector with links and a label for each, never pairs.

Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing; so do vectors of different
lengths, and rows without vec_id. Rows with one vec_id are one vector: it has the links of all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from shelfline.llm.common import BATCH, components, mix, staged
from shelfline.session import setting

COSINE = 0.95
CELL = 2048
CENTROIDS = 4096
SAMPLE = 20_000
ROUNDS = 8
BLOCK = 32_768
BYTES = 8 << 20
LEAF = 4096
TOGETHER = 32  # cells of a block that are compared at a time
STEPS = 8192
PAIRS = 1 << 20  # candidates that wait to be decided together
SIDE = 8   # blocks that a task of the product holds in memory
STRIPS = 16  # parts of the table that are read against them
PLACED_SCHEMA = "part int, d int, cell int, near float, id long, n long, vector binary"
BLOCK_SCHEMA = "no long, d int, ids binary, ns binary, cells binary, nears binary, vectors binary"


def unit(rows: list) -> np.ndarray:
    """Vectors of length one, in double precision; no row may be zero."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        cell = np.concatenate([(x[a:a + 2048] @ centroids.T).argmax(1) for a in range(0, len(x), 2048)])
        total = np.zeros_like(centroids)
        np.add.at(total, cell, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), centroids)
    return centroids


def reach(cosine: float, dimensions: int = 1) -> float:
    """How far from a border a class may have links beyond it: all of them; four deviations of them where
    differences are known to point evenly in so many dimensions, which data need not do."""
    return math.sqrt(1 - cosine * cosine) * min(1.0, 4 / math.sqrt(dimensions)) + 1e-9


def cells_of(x: np.ndarray, centroids: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) of every cell a row lives in or has a border with that is near."""
    near = x @ centroids.T
    home = near.argmax(1)
    gap = near[np.arange(len(x)), home][:, None] - near
    row, cell = np.nonzero(gap <= margin * apart(centroids, centroids)[home] + 1e-7)
    return row, cell, cell == home[row]


def apart(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * some @ others.T))


# ---------------------------------------------------------------- rows to blocks

def _packer(kind: type):
    """Vectors as bytes, NULL for those that link with nothing; 0 and -0 alike."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            at = lists.offsets.to_numpy()
            x = lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(kind) + kind(0)  # nulls are NaN
            at = at - at[0]
            count = lambda c: np.concatenate([[0], np.cumsum(c)])
            bad, used = count(~np.isfinite(x))[at], count(x != 0)[at]
            fine = (ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
                    & (bad[1:] == bad[:-1]) & (used[1:] > used[:-1]))
            packed = pa.Array.from_buffers(pa.binary(), len(ids), [
                pa.py_buffer(np.packbits(fine, bitorder="little").tobytes()),
                pa.py_buffer((at * x.itemsize).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([ids, packed], ["vec_id", "vector"])
    return pack


def _matrix(vectors: pa.Array, kind: type) -> np.ndarray:
    """Packed vectors of one length."""
    return np.frombuffer(b"".join(vectors.to_pylist()), kind).reshape(len(vectors), -1)


def _assigner(model):
    """The cell of each class and the part its block is packed in: cells in a row, each as wide as the sample says."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("vector")
            length = np.diff(np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset:][:len(vectors) + 1])
            spot = (mix(ids.to_numpy().astype(np.uint64)) >> np.uint64(11)) / 2.0 ** 53
            cell, near = np.full(len(ids), -1, np.int32), np.zeros(len(ids), np.float32)
            d, place = (length // np.dtype(m.kind).itemsize).astype(np.int32), np.empty(len(ids))
            for size in np.unique(d):
                at = np.flatnonzero(d == size)
                start, wide = m.places[size]
                if size == m.main:
                    x = unit(_matrix(vectors.take(pa.array(at)), m.kind)).astype(np.float32) @ m.centroids.T
                    cell[at] = x.argmax(1)
                    near[at] = x[np.arange(len(at)), cell[at]]
                    start, wide = start + m.starts[cell[at]], m.widths[cell[at]]
                place[at] = start + spot[at] * wide
            part = np.minimum(place * m.parts / m.total, m.parts - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(d), pa.array(cell), pa.array(near), ids, batch.column("n"), vectors],
                ["part", "d", "cell", "near", "id", "n", "vector"])
    return assign


def _blocker(rows: int, kind: type):
    """Sorted classes as blocks of one length of vectors, half as many rows again as a part should have at most."""
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, count = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            raw = lambda name, type_: t.column(name).to_numpy().astype(type_).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part + (made << 32)], pa.int64()), pa.array([t.column("d")[0].as_py()], pa.int32()),
                 pa.array([raw("id", np.int64)]), pa.array([raw("n", np.int64)]), pa.array([raw("cell", np.int32)]),
                 pa.array([raw("near", np.float32)]), pa.array([b"".join(t.column("vector").to_pylist())], pa.binary())],
                ["no", "d", "ids", "ns", "cells", "nears", "vectors"])
        for batch in batches:
            d = batch.column("d").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(d)) + 1), len(d)]
            for at, end in zip(edges, edges[1:]):
                while at < end:
                    most = max(1, min(rows * 3 // 2, BYTES * 3 // 2 // (int(d[at]) * np.dtype(kind).itemsize)))
                    if held and (count >= most or held[0].column("d")[0].as_py() != d[at]):
                        yield row()
                        made, held, count = made + 1, [], 0
                    some = batch.slice(at, min(most - count, end - at))
                    held.append(some)
                    at, count = at + len(some), count + len(some)
        if held:
            yield row()
    return block


# ---------------------------------------------------------------- pairs of blocks

def _opened(row: dict, m: SimpleNamespace) -> SimpleNamespace:
    """A block with its vectors in single precision, their leading directions, and its leaves."""
    read = lambda name, kind: np.frombuffer(row[name], kind)
    b = SimpleNamespace(no=row["no"], d=row["d"], ids=read("ids", np.int64), n=read("ns", np.int64), cell=read("cells", np.int32),
                        near=read("nears", np.float32), raw=read("vectors", m.kind).reshape(-1, row["d"]))
    # what products of these may err by
    b.eps = (b.d + 32) * 2.4e-7
    lead = m.lead if b.d == m.main else np.eye(b.d)[:, :leading(b.d)]
    b.x, b.bound = np.empty(b.raw.shape, np.float32), np.empty((len(b.raw), lead.shape[1] + 1), np.float32)
    for at in range(0, len(b.raw), 1024):
        x, y = b.raw[at:at + 1024], b.x[at:at + 1024]
        square = np.einsum("ij,ij->i", x, x)
        if square.min() > 1e-30 and square.max() < 1e30:
            np.multiply(x, (1 / np.sqrt(square))[:, None], out=y, casting="same_kind")
        else:
            y[:] = unit(x)
        z = y @ lead
        b.bound[at:at + 1024, :-1] = z
        b.bound[at:at + 1024, -1] = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", z, z)) + b.eps)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(b.cell)) + 1, [len(b.cell)]])
    b.starts = np.concatenate([np.linspace(a, e, -(-(e - a) // LEAF) + 1).astype(int)[:-1] for a, e in zip(edges, edges[1:])])
    b.ends = np.append(b.starts[1:], len(b.cell))
    b.leaf_cell = b.cell[b.starts]
    least = np.minimum.reduceat(b.near, b.starts).astype(float) - b.eps
    b.least = np.cos(np.minimum(math.pi, np.arccos(np.clip(least, -1, 1)) + math.acos(m.cosine))) - b.eps
    b.links = np.zeros(len(b.ids), np.int64)
    return b


def leading(d: int) -> int:
    """How many directions a first bound looks at."""
    return d if d < 16 else max(16, d // 4) - 1  # with the length of the rest a whole number of registers


def _cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, of=lambda x: x) -> np.ndarray:
    step = max(1, (1 << 20) // a.shape[1])
    return np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", of(a.take(i[k:k + step], axis=0)), of(b.take(j[k:k + step], axis=0)))
                                          for k in range(0, len(i), step))])


def _steps(gaps: np.ndarray) -> np.ndarray:
    """Gaps between the products with two centroids, at most 2, in whole steps from below."""
    return np.floor(gaps * np.float32(STEPS)).astype(np.int16)


def _chunks(b: SimpleNamespace) -> list[slice]:
    """Leaves of at most ``TOGETHER`` cells at a time: products with all centroids of a block could fill the memory."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(b.leaf_cell) != 0]))[::TOGETHER].tolist()
    return [slice(x, y) for x, y in zip(at, [*at[1:], len(b.starts)])]


def _candidates(a: SimpleNamespace, b: SimpleNamespace, m: SimpleNamespace) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose first bound reaches the threshold, each pair once."""
    same, low = a is b, m.cosine - a.eps
    for some in _chunks(a):
        for others in _chunks(b):
            if same and others.start < some.start:
                continue
            rows_a, rows_b = (slice(x.starts[c.start], x.ends[c.stop - 1]) for x, c in ((a, some), (b, others)))
            todo = np.ones((some.stop - some.start, others.stop - others.start), bool)
            if a.d == m.main:
                (cell_a, at_a), (cell_b, at_b) = (np.unique(x.leaf_cell[c], return_inverse=True) for x, c in ((a, some), (b, others)))
                to_b, to_a = m.centroids[cell_b] @ a.x[rows_a].T, m.centroids[cell_a] @ b.x[rows_b].T
                starts_a, starts_b = a.starts[some] - rows_a.start, b.starts[others] - rows_b.start
                # how much nearer the own centroid is; of two linked vectors the sum is at most the distance they may have, along the centroids'
                gap_a, gap_b = _steps(a.near[rows_a] - to_b), _steps(b.near[rows_b] - to_a)
                most = math.sqrt(2 - 2 * m.cosine) * apart(m.centroids[a.leaf_cell[some]], m.centroids[b.leaf_cell[others]])
                most = np.floor(STEPS * (most + 4 * a.eps)).astype(int)
                least_a, least_b = (np.minimum.reduceat(x, y, axis=1).astype(int) for x, y in ((gap_a, starts_a), (gap_b, starts_b)))
                todo = ((least_a[at_b].T + least_b[at_a] <= most)
                        & (np.maximum.reduceat(to_b, starts_a, axis=1)[at_b].T >= b.least[others][None, :])
                        & (np.maximum.reduceat(to_a, starts_b, axis=1)[at_a] >= a.least[some][:, None]))
            if same and some == others:
                todo = np.triu(todo)
            for p, q in zip(*(x.tolist() for x in np.nonzero(todo))):
                i, j = slice(a.starts[some.start + p], a.ends[some.start + p]), slice(b.starts[others.start + q], b.ends[others.start + q])
                if a.d == m.main:
                    here, there = slice(i.start - rows_a.start, i.stop - rows_a.start), slice(j.start - rows_b.start, j.stop - rows_b.start)
                    x, y, limit = gap_a[at_b[q], here], gap_b[at_a[p], there], int(most[p, q])  # a numpy number would widen the arrays
                    r = np.flatnonzero((x <= limit - int(least_b[at_a[p], q])) & (to_b[at_b[q], here] >= float(b.least[others.start + q])))
                    if not len(r):
                        continue
                    x = x.take(r)
                    c = np.flatnonzero((y <= limit - int(x.min())) & (to_a[at_a[p], there] >= float(a.least[some.start + p])))
                    if not len(c):
                        continue
                    y = y.take(c)
                    by_x, by_y = x.argsort(kind="stable"), y.argsort(kind="stable")  # of short numbers by their digits
                    x, y, i, j = x.take(by_x), y.take(by_y), r.take(by_x) + i.start, c.take(by_y) + j.start
                    step = max(64, -(-len(i) // 12))
                    ends = np.searchsorted(y, np.minimum(limit - x[::step].astype(int), 32767).astype(np.int16), "right").tolist()
                else:
                    i, j, step = np.arange(i.start, i.stop), np.arange(j.start, j.stop), 128
                    ends = [len(j)] * -(-len(i) // step)
                left, right = a.bound.take(i, axis=0), b.bound.take(j, axis=0).T
                for at, end in zip(range(0, len(i), step), ends):
                    if end:
                        hits = ((left[at:at + step] @ right[:, :end]).ravel() >= low).nonzero()[0]
                        if len(hits):
                            r, c = i[at + hits // end], j[hits % end]
                            once = r < c if same and a.starts[some.start + p] == b.starts[others.start + q] else slice(None)
                            yield r[once], c[once]


def _linked(a: SimpleNamespace, b: SimpleNamespace, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Counts the links among pairs of rows; id and the least id that each reaches by them."""
    value = _cosines(a.x, b.x, i, j)
    sure = (value >= cosine + a.eps) & (other := a.ids[i] != b.ids[j])
    doubt = np.flatnonzero((value >= cosine - a.eps) & ~sure & other)
    sure[doubt] = _cosines(a.raw, b.raw, i[doubt], j[doubt], unit) >= cosine
    i, j = i[sure], j[sure]
    np.add.at(a.links, i, b.n[j])
    np.add.at(b.links, j, a.n[i])
    (u, r), (v, c) = np.unique(a.ids[i], return_inverse=True), np.unique(b.ids[j], return_inverse=True)
    least_a, least_b = u.copy(), v.copy()
    while not np.array_equal(x := least_a[r], y := least_b[c]):
        np.minimum.at(least_a, r, np.minimum(x, y))
        np.minimum.at(least_b, c, np.minimum(x, y))
    return np.concatenate([[u, least_a], [v, least_b]], axis=1)


def _compared(a: SimpleNamespace, b: SimpleNamespace, m: SimpleNamespace) -> pa.RecordBatch:
    """id, links found and the least id that each reaches by the pairs that were looked at together."""
    labels, held, count = [], [], 0
    for pairs in _candidates(a, b, m):
        held.append(pairs)
        count += len(pairs[0])
        if count >= PAIRS:
            labels.append(_linked(a, b, *map(np.concatenate, zip(*held)), m.cosine))
            held, count = [], 0
    if held:
        labels.append(_linked(a, b, *map(np.concatenate, zip(*held)), m.cosine))
    found = [np.stack([x.ids, x.links, x.ids])[:, x.links > 0] for x in ([a] if a is b else [a, b])]
    if labels:
        pairs = np.unique(np.concatenate(labels, axis=1), axis=1)
        pairs = pairs[:, pairs[0] != pairs[1]]
        found.append(np.stack([pairs[0], np.zeros_like(pairs[0]), pairs[1]]))
    for x in (a, b):
        x.links[:] = 0
    return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)], ["id", "links", "label"])


def _comparer(model):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                row = {name: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for name, x in row.items()}
                if left is None or left.no != row["no"]:
                    left = None  # its memory goes first
                    left = _opened({k: row[k] if k in ("no", "d") else bytes(row[k])
                                    for k in row if not k.startswith("to_")}, model.value)
                right = left if row["to_no"] == left.no else _opened({k[3:]: row[k] for k in row if k.startswith("to_")}, model.value)
                yield _compared(left, right, model.value)
                right = None
    return compare


def near_groups(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row."""
    spark = vectors.sparkSession
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind = np.float32 if single else np.float64
    wide = np.dtype(kind).itemsize
    # two hashes of the vector tell classes apart
    hashed = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
              .mapInArrow(_packer(kind), "vec_id long, vector binary")
              .withColumns({"k1": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")),
                            "k2": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector")),
                            "d": (F.length("vector") / wide).cast("int")}))
    keys = staged(hashed.drop("vector"), "embed-keys")
    classes = staged(keys.where("k1 IS NOT NULL").distinct().groupBy("k1", "k2", "d")
                     .agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "embed-classes")
    sizes = {r["d"]: r["n"] for r in classes.groupBy("d").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return keys.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    main, total = min(sizes, key=lambda d: (-sizes[d], d)), sum(sizes.values())
    chosen = classes.where(F.col("d") == main).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("k1", "k2")
    sample = (hashed.join(F.broadcast(chosen), ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("vector").alias("vector"))
              .orderBy("k1", "k2").select("vector").collect())
    x = unit(np.frombuffer(b"".join(r["vector"] for r in sample), kind).reshape(-1, main))
    centroids = spherical_kmeans(x, min(CENTROIDS, math.ceil(sizes[main] / CELL)))
    share = np.bincount(np.concatenate([(x[a:a + 2048] @ centroids.T).argmax(1) for a in range(0, len(x), 2048)]),
                        minlength=len(centroids)) * (sizes[main] / len(x))
    starts = dict(zip(order := [main, *sorted(sizes.keys() - {main})], np.cumsum([0, *(sizes[d] for d in order)]).tolist()))
    rows = min(BLOCK, max(1, BYTES // (main * wide)), max(2048, math.ceil(total / 16)))
    parts = math.ceil(total / rows)
    model = spark.sparkContext.broadcast(SimpleNamespace(  # <= CENTROIDS vectors, and a quarter of the square of their length
        cosine=cosine, kind=kind, main=main, centroids=centroids.astype(np.float32), total=total, parts=parts,
        lead=np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :leading(main)], starts=np.cumsum(share) - share, widths=share,
        places={d: (starts[d], sizes[d]) for d in sizes}))
    # equal vectors are combined before they are shuffled, and shuffled by what the classes are
    distinct = (hashed.where("vector IS NOT NULL").groupBy("k1", "k2").agg(F.first("vector").alias("vector"))
                .join(classes, ["k1", "k2"]).select("id", "n", "vector"))
    blocks = staged(distinct.mapInArrow(_assigner(model), PLACED_SCHEMA).repartitionById(parts, F.col("part"))
                    .sortWithinPartitions("d", "cell", "near", "id").mapInArrow(_blocker(rows, kind), BLOCK_SCHEMA), "embed-blocks")
    left, right = blocks.coalesce(min(parts, STRIPS)), blocks.coalesce(math.ceil(parts / SIDE))
    right = right.select([F.col(c).alias("to_" + c) for c in blocks.columns])
    # of two blocks one meets the other, and each meets half of the others
    meets = "((no < to_no) = (pmod(no + to_no, 2) = 1)) AND d <= to_d AND d >= to_d"
    with setting(spark, BATCH, "1"):
        found = staged(left.join(right.hint("shuffle_replicate_nl"), F.expr(meets))
                       .mapInArrow(_comparer(model), "id long, links long, label long"), "embed-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")), "embed-components")
    # classes of one vector without links have no row here
    per_class = staged(classes.join(links.join(grouped, "id", "left"), "id", "left").where("n > 1 OR links IS NOT NULL")
                       .select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("class_links"),
                               F.coalesce("component", "id").alias("component")), "embed-linked")
    component = F.coalesce("component", "vec_id")
    return (keys.join(per_class, ["k1", "k2"], "left")
            .select("vec_id", F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))


#: All pairs, for tables as small as a test's.
ORACLE_SQL = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE len(embedding) > 0),
cosines AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.v, y.v) AS c
            FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)),
arcs AS (SELECT a, b FROM cosines WHERE isfinite(c) AND c >= {COSINE}),
reach(id, other) AS (SELECT a, b FROM arcs UNION SELECT r.id, e.b FROM reach r JOIN arcs e ON r.other = e.a),
least_of AS (SELECT id, min(other) AS other FROM reach GROUP BY id),
linked AS (SELECT a, count(*) AS n FROM arcs GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(other, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(other, e.vec_id) AS kept
FROM embeddings e LEFT JOIN linked k ON e.vec_id = k.a LEFT JOIN least_of l ON e.vec_id = l.id"""
