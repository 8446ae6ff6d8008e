"""Approximate nearest neighbours by largest inner product, with a hash-prefix forest per block of vectors.

A tree is a sorted array of long bit strings, one per vector, from random hyperplanes. A query descends in every
tree to its longest matching prefix, and ascends in all trees at once, a bit at a time, until the
ranges that share the prefix hold enough entries; what lies in them is scored exactly.

The index is cut into blocks of bounded size, so a block's forests fit a task, and neither the share of a block that
is scored nor the recall depends on the size of the corpus. Within a block, vectors of about one length are a shell with
a forest of its own, and shells are searched from the longest vectors on: once a query's k-th score is above what the
length of a shell allows, the shell and all after it are left out, which loses nothing. How far the ascent goes is measured: in each shell,
some of the queries are compared with all its vectors, and the least share is taken that finds enough of their best.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import named, read_table

TREES = 32
BITS = 32
# Entries that the ascent must gather over all trees, as shares of the shell's vectors: the least that reaches the
# recall on the probes is taken, and if none does, all vectors are scored.
SHARES = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.85, 1.0, 1.25, 1.5, 2.0)
RECALL = 0.96
PROBES = 48  # queries
SHELL_RATIO = 1.25  # of the lengths in a shell, if it has more than SHELL_ROWS vectors
SHELL_ROWS = 512
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
SEED = 11


class PrefixForest:
    """Trees over the rows of a matrix; inner products are turned into angles by one more component."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.trees, self.bits = trees, bits
        self.planes = rng.standard_normal((vectors.shape[1] + 1, trees * bits)).astype(np.float32)
        norms = np.linalg.norm(vectors, axis=1)
        self.most = norms.max(initial=0.0) or 1.0
        short = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.most) ** 2))
        strings = self._strings(np.column_stack([vectors / self.most, short]))
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def _strings(self, points: np.ndarray) -> np.ndarray:
        """Bit strings as numbers, the first bit highest; a row per tree."""
        bits = (points.astype(np.float32) @ self.planes > 0).reshape(len(points), self.trees, self.bits)
        return np.ascontiguousarray((bits @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))).T)

    def candidates(self, queries: np.ndarray, wanted: int, least: int = 0) -> list[np.ndarray]:
        """For each query the rows that the synchronous ascent gathers; all, if they are under ``least``."""
        norms = np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        strings = self._strings(np.column_stack([queries / norms, np.zeros(len(queries))]))
        shape = (self.trees, len(queries))
        low, high = np.zeros(shape, np.int64), np.full(shape, self.sorted.shape[1], np.int64)
        below = np.zeros((2, *shape), np.int64)  # ranges of the level before, a bit longer
        going = np.arange(len(queries))
        for level in range(self.bits, 0, -1):  # from the longest prefix upwards
            step = np.uint64(1) << np.uint64(self.bits - level)
            first = strings[:, going] & ~(step - np.uint64(1))
            lo = np.stack([np.searchsorted(s, f) for s, f in zip(self.sorted, first)])
            hi = np.stack([np.searchsorted(s, f) for s, f in zip(self.sorted, first + step)])
            enough = (hi - lo).sum(axis=0) >= wanted
            done = going[enough]
            # Of the last level, only as many trees as it takes ascend.
            had = below[1][:, done] - below[0][:, done]
            more = (hi - lo)[:, enough] - had
            rises = had.sum(axis=0) + np.cumsum(more, axis=0) - more < wanted
            low[:, done] = np.where(rises, lo[:, enough], below[0][:, done])
            high[:, done] = np.where(rises, hi[:, enough], below[1][:, done])
            going = going[~enough]
            below[0][:, going], below[1][:, going] = lo[:, ~enough], hi[:, ~enough]
            if not len(going):
                break
        found, marks = [], np.zeros(self.sorted.shape[1], bool)
        for q in range(len(queries)):
            marks[:] = False
            for order, lo, hi in zip(self.order, low[:, q], high[:, q]):
                marks[order[lo:hi]] = True
            rows = np.flatnonzero(marks)
            found.append(rows if len(rows) >= least else np.arange(len(marks)))
        return found


class Shell:
    """Vectors of about one length, in rows that their forest knows."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray):
        self.rows, self.ids, self.vectors = rows, ids[rows], vectors[rows]
        self.most = float(np.linalg.norm(self.vectors, axis=1).max(initial=0.0))
        self.forest = PrefixForest(self.vectors) if len(rows) > SHELL_ROWS // 2 else None
        self.share: float | None = None  # all

    def fit(self, query_ids: np.ndarray, queries: np.ndarray, k: int, target: float = RECALL) -> None:
        """Take the least share that finds ``target`` of the best k of some queries."""
        if self.forest is None:
            return
        at = np.unique(np.linspace(0, len(queries) - 1, min(PROBES, len(queries))).astype(int))
        scores = self.vectors @ queries[at].T
        scores[self.ids[:, None] == query_ids[at]] = -np.inf
        best = min(k, len(scores) - 1)
        bars = np.partition(scores, -best, axis=0)[-best]
        for share in SHARES:
            near = self.forest.candidates(queries[at], int(share * len(self.rows)), k + 1)
            hits = sum(min(best, int((scores[rows, i] >= bars[i]).sum())) for i, rows in enumerate(near))
            if hits >= target * best * len(at):
                self.share = share
                return

    def candidates(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        if self.forest is None or self.share is None:
            return [np.arange(len(self.rows))] * len(queries)
        return self.forest.candidates(queries, int(self.share * len(self.rows)), k + 1)  # the query itself may be among them


def shells_of(ids: np.ndarray, vectors: np.ndarray) -> list[Shell]:
    """The vectors by falling length, cut where the length has fallen by the ratio and the shell is large enough."""
    norms = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-norms, kind="stable")
    out, first = [], 0
    while first < len(order):
        last = int(np.searchsorted(-norms[order], -norms[order[first]] / SHELL_RATIO, "right"))
        last = max(last, first + SHELL_ROWS)
        if len(order) - last < SHELL_ROWS // 2:
            last = len(order)
        out.append(Shell(order[first:last], vectors, ids))
        first = last
    return out


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, scored: list[int] | None = None,
) -> list[tuple[int, int, float]]:
    """The k best (query, row, score) of a block for each query; ties go to the smaller id.

    ``scored`` gets the number of vectors that each query was compared with.
    """
    best = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
    bars, counts = np.full(len(queries), -np.inf), np.zeros(len(queries), np.int64)
    lengths = np.linalg.norm(queries, axis=1) * (1 + 1e-9)  # sums are rounded
    for shell in shells_of(ids, vectors):
        open_ = np.flatnonzero(lengths * shell.most >= bars)
        if not len(open_):
            break
        shell.fit(query_ids[open_], queries[open_], k)
        # Bounds the strings of many queries at once.
        for at in range(0, len(open_), 512):
            part = open_[at : at + 512]
            for q, rows in zip(part, shell.candidates(queries[part], k)):
                counts[q] += len(rows)
                rows = rows[shell.ids[rows] != query_ids[q]]
                scores = (shell.vectors[rows] * queries[q]).sum(axis=1)  # the same sum for equal rows, wherever they are
                near, scores = np.concatenate([best[q][0], shell.ids[rows]]), np.concatenate([best[q][1], scores])
                if len(near) > k:
                    top = scores >= np.partition(scores, -k)[-k]
                    near, scores = near[top], scores[top]
                order = np.lexsort((near, -scores))[:k]
                best[q] = near[order], scores[order]
                if len(order) == k:
                    bars[q] = scores[order[-1]]
    if scored is not None:
        scored += counts.tolist()
    return [(query, i, x) for query, (near, scores) in zip(query_ids, best) for i, x in zip(near, scores)]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best found for each query, nearest first.

    ``queries`` has the columns of ``vectors``. A vector that is null, empty, zero or has a null or non-finite
    component takes no part, nor does a row without an id; vectors are compared with those of their length only. Rows
    with one id count once, the least vector of them. A query with no candidate has no row.

    Every query meets every block, a part of the queries and a block to a task: the work grows with the
    product of both, as recall on vectors without clusters requires, and the largest task does not grow. Ids must read as longs.
    """
    points, asked = _valid(vectors, id_col, vector_col), _valid(queries, id_col, vector_col)
    sizes = points.groupBy("length").agg(F.countDistinct("id").alias("n")).collect()  # a row per length of vector
    asked_sizes = {r["length"]: r["n"] for r in asked.groupBy("length").agg(F.countDistinct("id").alias("n")).collect()}
    blocks, parts = F.lit(1), F.lit(1)
    for r in sizes:
        here = F.col("length") == r["length"]
        blocks = F.when(here, F.lit(-(-r["n"] // block_rows))).otherwise(blocks)
        parts = F.when(here, F.lit(max(1, -(-asked_sizes.get(r["length"], 0) // query_rows)))).otherwise(parts)
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    keys = ["length", "block", "part"]
    index = points.withColumn("block", place(blocks, 1)).withColumn("part", every(parts))
    asking = asked.withColumn("part", place(parts, 2)).withColumn("block", every(blocks))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64").astype({"score": "float64"})
        left, right = (_once(x) for x in (left, right))
        found = search_block(
            left["id"].to_numpy(np.int64), np.stack(left["vector"].to_numpy()),
            right["id"].to_numpy(np.int64), np.stack(right["vector"].to_numpy()), k,
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    met = index.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _once(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per id, in the order of the ids."""
    keyed = rows.assign(key=rows["vector"].map(tuple)) if rows["id"].duplicated().any() else rows.assign(key=0)
    return keyed.sort_values(["id", "key"]).drop_duplicates("id").drop(columns="key")


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = named(df, id_col, vector_col).toDF("id", "vector").where("id is not null and vector is not null")
    rows = rows.select(F.col("id").cast("long"), F.col("vector").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(sound & F.exists("vector", lambda x: x != 0)).withColumn("length", F.size("vector"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
