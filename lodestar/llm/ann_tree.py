"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is then put into a leaf.
A query walks the tree best-bin-first: a priority queue holds the nodes next
to the path by their centre's distance, and leaves are visited in the order in
which they leave the queue.  How many leaves are visited is widened until a
sample of queries, searched by brute force over all rows, reaches the target
recall.  Leaves of vectors and of queries meet in bounded chunks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

SAMPLE = 20_000  # vectors that the tree is fitted on, at most
BRANCHES = 8
LEAF = 64  # sample vectors of a node that is not divided further
CALIBRATION = 200  # queries that set the number of leaves, at most
TARGET_RECALL = 0.97
CHUNK_ROWS = 20_000  # vectors, and queries, that meet in one group at most
STEP_VALUES = 4_000_000  # rough distances that are held at once, at most


def usable(column: str) -> Column:
    """Not null, not empty, not zero, every component a finite number."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


class Tree:
    """Hierarchical k-means; ``descend`` and ``order`` name leaves by number."""

    def __init__(self, points: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.centres: list[np.ndarray] = []  # of each inner node's children
        self.children: list[list[int]] = []  # inner node >= 0, leaf -1 - number
        self.leaves = 0
        self.root = self._node(points.astype(np.float64), branches, leaf, rng)

    def _node(self, points, branches, leaf, rng) -> int:
        groups = self._split(points, branches, rng) if len(points) > leaf else None
        if groups is None:
            self.leaves += 1
            return -self.leaves
        me = len(self.centres)
        self.centres.append(groups[0])
        self.children.append([])
        self.children[me] = [self._node(points[groups[1] == g], branches, leaf, rng) for g in range(len(groups[0]))]
        return me

    @staticmethod
    def _split(points, branches, rng):
        centres = points[rng.choice(len(points), min(branches, len(points)), replace=False)]
        for _ in range(10):
            d = (points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :]
            own = d.argmin(1)
            centres = np.stack([points[own == g].mean(0) if (own == g).any() else c for g, c in enumerate(centres)])
        used = np.unique(own)
        if len(used) < 2:
            return None
        return centres[used], np.searchsorted(used, own)

    def descend(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point: the nearest child, again and again."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = -1 - node
                continue
            c = self.centres[node]
            x = points[at]
            own = ((c ** 2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
            todo += [(child, at[own == g]) for g, child in enumerate(self.children[node]) if (own == g).any()]
        return out

    def order(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        queue: list[tuple[float, int]] = [(0.0, self.root)]
        out: list[int] = []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                continue
            d = ((self.centres[node] - query) ** 2).sum(1)
            for child, at in zip(self.children[node], d.tolist()):
                heapq.heappush(queue, (at, child))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _nearest(queries: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int):
    """(query row, id, distance) of the k nearest to each query, ties to the
    smaller id; distances from the differences themselves."""
    out = []
    step = max(1, STEP_VALUES // max(1, len(points)))
    norms = (points ** 2).sum(1)[None, :]
    for i in range(0, len(queries), step):
        rough = None
        if len(points) > 4 * k:
            rough = queries[i:i + step] @ points.T
            rough *= -2
            rough += norms
        for j in range(i, min(i + step, len(queries))):
            if rough is None:
                some = np.arange(len(points))
            else:  # all that rounding could bring among the k nearest
                limit = np.partition(rough[j - i], k - 1)[k - 1]
                some = np.nonzero(rough[j - i] <= limit + 1e-9 * (1.0 + abs(limit) + (queries[j] ** 2).sum()))[0]
            d = np.sqrt(((points[some] - queries[j]) ** 2).sum(1))
            first = np.lexsort((ids[some], d))[:k]
            out.append((np.full(len(first), j), ids[some][first], d[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _top(found: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _brute(index: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact search of a bounded set of queries: each task keeps its k best."""
    held = index.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches):
        names, queries = held.value
        kept = None
        for batch in batches:
            q, v, d = _nearest(queries, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)
            leaf = pd.Series(batch.column(2).to_numpy(), batch.column(0).to_numpy())
            now = pd.DataFrame({"query_id": names[q], "vec_id": v, "score": d, "leaf": leaf.loc[v].to_numpy()})
            kept = now if kept is None else pd.concat([kept, now])
            kept = kept.sort_values(["query_id", "score", "vec_id"]).groupby("query_id").head(k)
        if kept is not None:
            yield pa.RecordBatch.from_pandas(kept, preserve_index=False)

    near = index.select("vec_id", "v", "leaf").mapInArrow(run, "query_id long, vec_id long, score double, leaf long")
    return _top(near, "query_id", k)


def _chunked(rows: DataFrame, id_col: str, name: str, chunk_rows: int) -> DataFrame:
    """Adds a chunk number within the leaf, and the leaf's number of chunks."""
    counts = rows.groupBy("leaf").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias(f"{name}s"))
    return rows.join(F.broadcast(counts), "leaf").withColumn(  # a row a leaf: bounded by the sample
        name, F.pmod(F.xxhash64(id_col), F.col(f"{name}s")).cast("int"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           target_recall: float = TARGET_RECALL, sample: int = SAMPLE, branches: int = BRANCHES, leaf: int = LEAF,
           chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found by Euclidean
    distance of the rows of ``vectors`` to each of ``queries``, own key left out.

    Vectors that are null, empty, zero or hold a null or non-finite component
    take no part; nor do those of another length than the most frequent (of
    equals the smaller), nor rows with a null key.  Ties go to the smaller
    key.  Equal vectors share a place in the index, which keeps the k + 1
    smallest keys of each: no more can be among a query's k nearest.
    """
    spark = vectors.sparkSession
    clean = [df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
             .filter(F.col("vec_id").isNotNull() & usable("v")) for df in (vectors, queries)]
    width = clean[0].groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if width is None:
        return empty
    rows, asked = (df.filter(F.size("v") == width.w) for df in clean)

    same = Window.partitionBy("v").orderBy("vec_id")
    some = rows.dropDuplicates(["vec_id", "v"]).withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1)
    part = some.filter(F.col("r") == 1).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    tree = Tree(_matrix(part.column("v").combine_chunks()), branches, leaf)
    held = spark.sparkContext.broadcast(tree)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(held.value.descend(_matrix(batch.column(1))))],
                    ["vec_id", "v", "leaf"])

    kind = rows.schema["v"].dataType.simpleString()
    index = cut(some.select("vec_id", "v").mapInArrow(assign, f"vec_id long, v {kind}, leaf long"), "ann-index")

    # queries of equal vectors are one search
    asked = cut(asked.dropDuplicates(["vec_id", "v"]).withColumn("rep", F.min("vec_id").over(Window.partitionBy("v"))),
                "ann-queries")
    reps = asked.filter(F.col("vec_id") == F.col("rep")).select(F.col("rep").alias("query_id"), "v")
    tried = reps.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toArrow()
    if not tried.num_rows:
        return empty
    names, points = tried.column("query_id").to_numpy(), _matrix(tried.column("v").combine_chunks())
    place = {q: {leaf: i for i, leaf in enumerate(tree.order(x, tree.leaves))} for q, x in zip(names.tolist(), points)}
    needed = np.array([place[r.query_id][r.leaf] + 1 for r in _brute(index, names, points, k + 1).collect()])
    visits = int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(target_recall * len(needed))) - 1)])

    def walk(batches):
        for batch in batches:
            xs = _matrix(batch.column(1))
            order = [held.value.order(x, visits) for x in xs]
            n = np.array([len(o) for o in order], np.int64)
            at = pa.array(np.repeat(np.arange(len(order)), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([x for o in order for x in o], pa.int64())],
                ["query_id", "v", "leaf"])

    walks = cut(reps.mapInArrow(walk, f"query_id long, v {kind}, leaf long"), "ann-walks")
    left = _chunked(index, "vec_id", "chunk", chunk_rows)
    right = _chunked(walks, "query_id", "part", chunk_rows)
    sizes = left.select("leaf", "chunks").distinct(), right.select("leaf", "parts").distinct()
    left = left.join(F.broadcast(sizes[1]), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = right.join(F.broadcast(sizes[0]), "leaf").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def meet(points: pa.Table, asked: pa.Table) -> pa.Table:
        if not points.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        q, v, d = _nearest(_matrix(asked.column("v").combine_chunks()), points.column("vec_id").to_numpy(),
                           _matrix(points.column("v").combine_chunks()), k + 1)
        return pa.table({"query_id": asked.column("query_id").to_numpy()[q], "vec_id": v, "score": d})

    keys = ["leaf", "chunk", "part"]
    found = left.select(*keys, "vec_id", "v").groupBy(*keys).cogroup(
        right.select(*keys, "query_id", "v").groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    best = _top(found, "query_id", k + 1).select(F.col("query_id").alias("rep"), "vec_id", "score") \
        .groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))  # k + 1 at most
    mine = asked.select(F.col("vec_id").alias("query_id"), "rep").join(best, "rep").select(
        "query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def op3_query(vectors: DataFrame) -> DataFrame:
    """The ten nearest rows to each row whose vec_id is divisible by 100."""
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
