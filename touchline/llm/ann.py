"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample (``SAMPLE`` rows, the smallest hashes of
id and vector, thinned by hash before they meet in one task); every row is then indexed by descending to its leaf.  A query walks
the tree best bin first: a priority queue holds the branches it hasn't taken,
by the distance to their centres, so leaves come in a promising order and the
walk can be widened leaf by leaf.  How many leaves a search visits is
calibrated: for ``CALIBRATION`` rows the true neighbours are computed against
all rows, and the visits are the fewest that find ``TARGET`` of them.  A search
goes on past that number while its leaves hold fewer than k candidates.

Queries meet vectors by a join on the leaf.  A leaf of many rows is split into
blocks of rows and of queries, and every block of one meets every block of the
other, so a leaf that a third of all rows share isn't one task's work and
nothing is left out.  Distances are Euclidean in double precision on the
original vectors.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those whose length isn't the commonest one
(the smaller of equally common ones); a repeated vec_id asks once, with its
smallest vector, and its other rows are candidates like any, be they equal to it
or not; a null vec_id takes no part; ties go to the smaller vec_id; an empty
table gives no rows; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, seeded, stored, table

by_value(__name__)

SAMPLE = 16_384
BRANCH = 8
LEAF_SAMPLE = 128
CALIBRATION = 256
TARGET = 0.97
K = 10
ROW_BLOCK = 20_000
QUERY_BLOCK = 2_000


@dataclass
class Node:
    centers: np.ndarray
    children: list = field(default_factory=list)  # a Node, or a leaf's number


@dataclass
class Tree:
    root: Node | int
    leaves: int


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's rounds from spread-out starting points."""
    pick = int(seeded(1, seed)[0] % len(x))
    centers = [x[pick]]
    near = ((x - x[pick]) ** 2).sum(axis=1)
    while len(centers) < k and near.max() > 0:
        centers.append(x[int((near * (seeded(len(x), seed + len(centers)) / 2.0**64)).argmax())])
        near = np.minimum(near, ((x - centers[-1]) ** 2).sum(axis=1))
    c = np.array(centers)
    for _ in range(rounds):
        of = closest(x, c)
        used = np.bincount(of, minlength=len(c))
        for i in np.flatnonzero(used):
            c[i] = x[of == i].mean(axis=0)
    return c[np.unique(closest(x, c))]


def closest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def grow(x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF_SAMPLE) -> Tree:
    """A tree whose leaves hold at most ``leaf`` rows of x, unless equal rows
    can't be told apart."""
    leaves = 0

    def build(rows: np.ndarray, seed: int):
        nonlocal leaves
        if len(rows) > leaf:
            c = kmeans(rows, branch, seed)
            if len(c) > 1:
                of = closest(rows, c)
                return Node(c, [build(rows[of == i], seed * branch + i + 1) for i in range(len(c))])
        leaves += 1
        return leaves - 1

    root = build(x, 1)
    return Tree(root, leaves)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row, by the nearest centre at every level."""
    out = np.zeros(len(x), np.int32)
    todo = [(tree.root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, Node):
            out[rows] = node
        elif len(rows):
            of = closest(x[rows], node.centers)
            todo.extend((child, rows[of == i]) for i, child in enumerate(node.children))
    return out


def best_bins(tree: Tree, q: np.ndarray) -> Iterator[int]:
    """Leaves in best-bin-first order."""
    queue: list[tuple[float, int, Node | int]] = [(0.0, 0, tree.root)]
    n = 1
    while queue:
        _, _, node = heapq.heappop(queue)
        while isinstance(node, Node):
            d = ((node.centers - q) ** 2).sum(axis=1)
            order = np.argsort(d, kind="stable")
            for i in order[1:]:
                heapq.heappush(queue, (float(d[i]), n, node.children[i]))
                n += 1
            node = node.children[order[0]]
        yield node


def visit(tree: Tree, q: np.ndarray, visits: int, sizes: np.ndarray, k: int) -> list[int]:
    """The first ``visits`` leaves, and more until they hold k + 1 rows."""
    out, rows = [], 0
    for leaf in best_bins(tree, q):
        if len(out) >= visits and rows > k:
            break
        out.append(leaf)
        rows += int(sizes[leaf])
    return out


def matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, v (array<double>) of the vectors that take part, and their number."""
    v = F.col("embedding").cast("array<double>")
    fine = (
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    kept = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    common = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return kept.where(F.size("v") == (common["d"] if common else 0)), common["count"] if common else 0


def smallest_hashes(rows: DataFrame, n: int, total: int, seed: str) -> pa.Table:
    """The ``n`` of ``total`` rows (vec_id, v) with the smallest hashes.  About twice as
    many are let through by hash first, so the task that sorts them meets no
    more, however many partitions there are; rows so much alike that too few
    come through are sorted as they are."""
    key = F.xxhash64(F.lit(seed), "vec_id", "v")
    chosen = lambda of: of.orderBy(key, "vec_id").limit(n).toArrow()
    if total <= 2 * n:
        return chosen(rows)
    got = chosen(rows.where(F.pmod(key, F.lit(1 << 30)) < F.lit((2 * n << 30) // total)))
    return got if got.num_rows >= n // 2 else chosen(rows)


def indexed(vectors: DataFrame, tree: Tree) -> DataFrame:
    """vec_id, v, leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf_of(tree, matrix(batch.column(1))))], names=["vec_id", "v", "leaf"])

    return vectors.mapInArrow(run, "vec_id long, v array<double>, leaf int")


def nearest(ids: np.ndarray, x: np.ndarray, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the k nearest rows but the query's own, which is
    one row of its id and its vector; another such row is a candidate."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    same_id = np.flatnonzero(ids == own)
    d[same_id[(x[same_id] == q).all(axis=1)][:1]] = np.inf
    order = np.lexsort((ids, d))[: k + 1]
    order = order[np.isfinite(d[order])][:k]
    return order, d[order]


def calibrate(rows: DataFrame, tree: Tree, sizes: np.ndarray, k: int) -> int:
    """The fewest leaf visits that find ``TARGET`` of the true neighbours of
    the calibration rows among all rows."""
    chosen = smallest_hashes(rows.select("vec_id", "v"), CALIBRATION, int(sizes.sum()), "calibrate")
    own, q = chosen.column("vec_id").to_numpy(), matrix(chosen.column("v").combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x, leaf = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy()
            out = [nearest(ids, x, own[i], q[i], k) for i in range(len(own))]
            at = np.concatenate([o for o, _ in out])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(own)), [len(o) for o, _ in out])),
                    pa.array(ids[at]),
                    pa.array(np.concatenate([d for _, d in out])),
                    pa.array(leaf[at]),
                ],
                names=["query", "vec_id", "score", "leaf"],
            )

    found = rows.mapInArrow(run, "query long, vec_id long, score double, leaf int")
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("_n") <= k)
    truth = best.groupBy("query").agg(F.collect_list("leaf").alias("leaves")).collect()
    order = {}
    needed = []
    for row in truth:
        order = {leaf: n for n, leaf in enumerate(best_bins(tree, q[row["query"]]))}
        needed.extend(order[leaf] + 1 for leaf in row["leaves"])
    if not needed:
        return tree.leaves
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]


def search(vectors: DataFrame, is_query, k: int = K, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for
    which ``is_query`` holds."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    fine, total = usable(vectors)
    drawn = smallest_hashes(fine, sample, total, "sample")
    if not drawn.num_rows:
        return spark.createDataFrame([], out)
    tree = grow(matrix(drawn.column("v").combine_chunks()))
    rows = stored(indexed(fine, tree), "vectors")
    counts = rows.groupBy("leaf").agg(F.count("*").alias("n"), F.count_if(is_query).alias("queries")).collect()  # a row a leaf
    sizes = np.zeros(tree.leaves, np.int64)
    for c in counts:
        sizes[c["leaf"]] = c["n"]
    visits = calibrate(rows, tree, sizes, k)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1)) if len(batch) else []
            leaves = pa.array([visit(tree, q, visits, sizes, k) for q in x], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), leaves], names=["query_id", "q", "leaves"])

    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(walk, "query_id long, q array<double>, leaves array<int>")
    visited = stored(queries.select("query_id", "q", F.explode("leaves").alias("leaf")), "visits")
    asked = {r["leaf"]: r["n"] for r in visited.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    blocks = spark.createDataFrame(
        [(i, -(-int(sizes[i]) // ROW_BLOCK), -(-n // QUERY_BLOCK)) for i, n in asked.items() if sizes[i]], "leaf int, row_blocks long, query_blocks long"
    )  # a row a leaf
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n))
    left = visited.join(F.broadcast(blocks), "leaf").select("leaf", every("row_blocks").alias("a"), own("query_blocks", "query_id").alias("b"), "query_id", "q")
    # equal rows share a block, so a query meets all rows like its own at once
    right = rows.join(F.broadcast(blocks), "leaf").select("leaf", own("row_blocks", "vec_id", "v").alias("a"), every("query_blocks").alias("b"), "vec_id", "v")

    def score(key, qs: pa.Table, xs: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if qs.num_rows and xs.num_rows:
            ids, x = xs.column("vec_id").to_numpy(), matrix(xs.column("v").combine_chunks())
            for own_id, q in zip(qs.column("query_id").to_numpy(), matrix(qs.column("q").combine_chunks()), strict=True):
                at, d = nearest(ids, x, own_id, q, k)
                found["query_id"].append(np.full(len(at), own_id))
                found["vec_id"].append(ids[at])
                found["score"].append(d)
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({n: np.concatenate(v).astype(kinds[n]) if v else np.zeros(0, kinds[n]) for n, v in found.items()})

    key = ["leaf", "a", "b"]
    pairs = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_kmeans_tree(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every vec_id divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 100 == 0)
