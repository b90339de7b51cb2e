"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on ``SAMPLE`` vectors at most, those with the smallest hash of their id; its centres, at
most a few hundred, are broadcast.  Every vector is then filed in a leaf.  A query walks the tree
best bin first: a priority queue holds the nodes met so far, and the one whose centre has the largest inner
product with the query is opened next, until enough leaves are found.  How many are enough is
calibrated: the visits are widened until the neighbours of ``CALIBRATION`` queries, found by brute force,
are among the leaves' vectors with the wanted recall.

Queries and vectors meet in cells: a cell is a bounded slice of the vectors of one branch of the tree, with a
bounded slice of the queries that visit it, however full a leaf is.  Of equal vectors only the k + 1
smallest ids can be among any k neighbours (one may be the query itself), so no more are filed.

Cases: vectors that are null, zero, of another length than most, or that hold a null or a number that is not
finite take no part, as query or candidate.  Ties go to the smaller id.  Rows that repeat an id are candidates
each, and are not found by their own id.  With fewer candidates than wanted, all are returned.  Only id and
vector are read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeglass.llm.common import longs, stage

K = 20
SAMPLE = 20_000
CALIBRATION = 128
RECALL = 0.95
BRANCHES = 16
# Sampled vectors of a node that is not split further.
_LEAF = 128
# Vectors and queries that meet in one task.
CELL_VECTORS, CELL_QUERIES = 20_000, 20_000


@dataclass
class Node:
    centre: np.ndarray
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


def _means(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows; the label of each row."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), k, replace=False)]
    labels = np.zeros(len(rows), int)
    for _ in range(10):
        labels = (0.5 * (centres * centres).sum(axis=1) - rows @ centres.T).argmin(axis=1)
        for j in range(k):
            if (own := labels == j).any():
                centres[j] = rows[own].mean(axis=0)
    return labels


class Tree:
    def __init__(self, rows: np.ndarray):
        self.leaves = 0
        self.root = self._grown(rows.astype(np.float64), 0)
        self.branch: list[int] = [0] * self.leaves
        for number, child in enumerate(self.root.children):
            for leaf in self._below(child):
                self.branch[leaf] = number

    def _grown(self, rows: np.ndarray, depth: int) -> Node:
        node = Node(rows.mean(axis=0))
        if len(rows) > _LEAF or not depth:
            labels = _means(rows, min(BRANCHES, len(rows)), depth)
            parts = [rows[labels == j] for j in np.unique(labels)]
            if len(parts) > 1 or not depth:
                node.children = [self._grown(part, depth + 1) for part in parts]
                return node
        node.leaf = self.leaves
        self.leaves += 1
        return node

    def _below(self, node: Node) -> list[int]:
        return [node.leaf] if node.leaf >= 0 else [leaf for child in node.children for leaf in self._below(child)]

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at each level."""
        leaves = np.zeros(len(rows), np.int64)
        work = [(self.root, np.arange(len(rows)))]
        while work:
            node, own = work.pop()
            if node.leaf >= 0:
                leaves[own] = node.leaf
            elif len(own):
                centres = np.stack([child.centre for child in node.children])
                nearest = (0.5 * (centres * centres).sum(axis=1) - rows[own] @ centres.T).argmin(axis=1)
                work += [(child, own[nearest == j]) for j, child in enumerate(node.children)]
        return leaves

    def visited(self, query: np.ndarray, most: int) -> list[int]:
        """The leaves that the query visits, best bin first."""
        found: list[int] = []
        queue = [(0.0, 0, self.root)]
        pushed = 0
        while queue and len(found) < most:
            _, _, node = heapq.heappop(queue)
            if node.leaf >= 0:
                found.append(node.leaf)
                continue
            for child in node.children:
                pushed += 1
                heapq.heappush(queue, (-float(query @ child.centre), pushed, child))
        return found


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score, at): the k best rows for each query, without rows of its own id."""
    parts = []
    for first in range(0, len(queries), 256):
        block, own = queries[first : first + 256], query_ids[first : first + 256]
        rough = block @ rows.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        if rough.shape[1] > k:
            floor = np.partition(rough, -k, axis=1)[:, -k]
            # Room for rounding: the product of matrices adds in another order than the score.
            floor = floor - 1e-9 * (1 + np.abs(floor))
        else:
            floor = np.full(len(block), -np.inf)
        q, at = np.nonzero((rough >= floor[:, None]) & (rough > -np.inf))
        score = (block[q] * rows[at]).sum(axis=1)
        order = np.lexsort((ids[at], -score, q))
        q, at, score = q[order], at[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < k
        parts.append(pd.DataFrame({"query_id": own[q[keep]], "vec_id": ids[at[keep]], "score": score[keep], "at": at[keep]}))
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "at": []})


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.filter(F.size("v") == (sizes["size"] if sizes else 0))


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    taken = rows.select("vec_id", "v").toArrow().combine_chunks()
    ids = taken.column("vec_id").to_numpy()
    return ids, _matrix(taken.column("v").combine_chunks()) if len(ids) else np.zeros((0, 0))


def _calibrated(tree: Tree, filed: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """How many leaves to visit.  The sample of queries is compared with all vectors; each task returns its
    best for each of them."""
    ids, sample = _collected(queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION))
    if not len(ids):
        return 1
    shared = filed.sparkSession.sparkContext.broadcast((ids, sample))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own = shared.value
        best: pd.DataFrame | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _best(own, own_ids, _matrix(batch.column(1)), batch.column(0).to_numpy(), k)
            found["leaf"] = batch.column(2).to_numpy()[found["at"].to_numpy(dtype=int)]
            both = found if best is None else pd.concat([best, found], ignore_index=True)
            both = both.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            best = both[both.groupby("query_id").cumcount() < k]
        if best is not None:
            yield pa.RecordBatch.from_pandas(best[["query_id", "vec_id", "score", "leaf"]], preserve_index=False)

    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = (
        filed.select("vec_id", "v", "leaf")
        .mapInArrow(nearest, "query_id bigint, vec_id bigint, score double, leaf bigint")
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= k)
        .select("query_id", "leaf")
        .collect()
    )
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.visited(v, tree.leaves), 1)} for i, v in zip(ids, sample, strict=True)}
    needed = sorted(place[row["query_id"]][row["leaf"]] for row in true)
    return needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)] if needed else 1


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = K,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For the vectors whose id is divisible by ``every``, the k nearest found: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = stage(_usable(vectors, id_col, vector_col), "vectors")
    among = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    distinct = rows.withColumn("copy", F.row_number().over(among)).filter(F.col("copy") <= k + 1)
    _, sample = _collected(
        distinct.filter("copy = 1").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    )
    schema = "query_id long, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree(sample)
    shared = spark.sparkContext.broadcast(tree)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.file(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.record_batch([*batch.columns, pa.array(leaves)], names=["vec_id", "v", "leaf"])

    own = rows.schema["v"].dataType.simpleString()
    filed = stage(distinct.select("vec_id", "v").mapInArrow(file, f"vec_id bigint, v {own}, leaf bigint"), "vectors-filed")
    queries = rows.filter(F.col("vec_id") % every == 0)
    visits = _calibrated(tree, filed, queries, k, recall)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per query and branch with the leaves that the query visits there."""
        branch = shared.value.branch
        for batch in batches:
            out: dict[str, list] = {"query_id": [], "q": [], "branch": [], "leaves": []}
            if batch.num_rows:
                for query, vector, row in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), _matrix(batch.column(1)), strict=True
                ):
                    by_branch: dict[int, list[int]] = {}
                    for leaf in shared.value.visited(row, visits):
                        by_branch.setdefault(branch[leaf], []).append(leaf)
                    for number, leaves in by_branch.items():
                        for name, value in zip(out, (query, vector, number, leaves), strict=True):
                            out[name].append(value)
            kinds = [pa.int64(), batch.schema.field(1).type, pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(out[name], kind) for name, kind in zip(out, kinds, strict=True)]
            yield pa.record_batch(columns, names=list(out))

    walks = stage(
        queries.mapInArrow(walk, f"query_id bigint, q {own}, branch bigint, leaves array<bigint>"), "vector-queries"
    )
    # Slices of vectors and of queries per branch, of bounded size.
    branches = max(tree.branch) + 1
    branch_of = filed.withColumn("branch", F.get(longs(tree.branch), F.col("leaf")))
    filled = {r["branch"]: r["n"] for r in branch_of.groupBy("branch").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["branch"]: r["n"] for r in walks.groupBy("branch").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = longs([max(1, -(-filled.get(b, 0) // CELL_VECTORS)) for b in range(branches)])
    chunks = longs([max(1, -(-asked.get(b, 0) // CELL_QUERIES)) for b in range(branches)])
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.get(n, F.col("branch")) - 1))
    cells = ["branch", "slice", "chunk"]
    left = branch_of.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.get(slices, F.col("branch"))))
    left = left.withColumn("chunk", upto(chunks)).select(*cells, "vec_id", "v", "leaf")
    right = walks.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.get(chunks, F.col("branch"))))
    right = right.withColumn("slice", upto(slices)).select(*cells, "query_id", "q", "leaves")

    def meet(filed_: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(filed_) and len(asking):
            vectors_, ids = np.stack(filed_["v"]).astype(np.float64), filed_["vec_id"].to_numpy()
            points, query_ids = np.stack(asking["q"]).astype(np.float64), asking["query_id"].to_numpy()
            leaf_of = filed_["leaf"].to_numpy()
            visitors: dict[int, list[int]] = {}
            for at, leaves in enumerate(asking["leaves"]):
                for leaf in leaves:
                    visitors.setdefault(int(leaf), []).append(at)
            for leaf, at in visitors.items():
                own_ = leaf_of == leaf
                if own_.any():
                    found.append(_best(points[at], query_ids[at], vectors_[own_], ids[own_], k))
        both = pd.concat(found, ignore_index=True) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        both = both.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return both[both.groupby("query_id").cumcount() < k][["query_id", "vec_id", "score"]]

    met = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInPandas(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
