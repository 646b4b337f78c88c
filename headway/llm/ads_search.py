"""Nearest neighbours by inner product: adaptive dimension scan over inverted lists.

Inner product is turned into distance by one more dimension (the part of the
greatest norm that a vector lacks), and all vectors are rotated by one random
orthogonal matrix, so that any leading dimensions are a random projection.
Vectors lie in inverted lists around centroids; a query probes its nearest
lists.  Within a list the vectors' columns are read in blocks: after each block
a vector's distance so far, scaled up to all dimensions, is tested against the
query's threshold, and vectors that the test rejects are left.  Vectors that
survive all blocks are scored exactly on the original numbers.

The number of probed lists is fitted: a bounded sample of queries is searched
exactly, and the least number of lists that holds ``FITTED`` of their true
neighbours is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.store import materialise

K = 20
#: Vectors a list should have, and the greatest number of lists.
LIST_ROWS = 2_048
MAX_LISTS = 4_096
#: Rows of a list that one task scans together; longer lists are split.
BLOCK_ROWS = 8_192
#: Vectors drawn to fit centroids, how many of them give a query its first threshold, and
#: queries drawn to fit the number of lists.
SAMPLE = 8_192
FIRST = 1_024
FIT_QUERIES = 128
FITTED = 0.98
#: Columns after which candidates are tested, and the strictness of the test.
COLUMNS = 16
EPSILON = 2.1


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, norm2) without vectors that are null or empty, zero, or hold null, NaN or infinity."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
        .where(F.col("v").isNotNull() & (F.size("v") > 0))
        .where(F.coalesce(finite, F.lit(False)))
        .withColumn("norm2", norm2)
        .where("norm2 > 0")
    )


def one_width(vectors: DataFrame) -> DataFrame:
    """One vector a vec_id, all of the width that most rows have (the smaller at a tie).

    Of several vectors of one vec_id the greatest counts, compared number by number."""
    widths = vectors.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = widths.orderBy(F.desc("n"), "width").first()
    rows = vectors if common is None else vectors.where(F.size("v") == common.width)
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return rows.groupBy("vec_id").agg(F.max("v").alias("v")).withColumn("norm2", norm2)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Index:
    """What every task needs, of bounded size: rotation, centroids, sample."""

    def __init__(self, width: int, top_norm2: float, ids: np.ndarray, sample: np.ndarray, lists: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.width, self.top = width, top_norm2
        self.rotation = np.linalg.qr(rng.standard_normal((width + 1, width + 1)))[0]
        self.centroids = self._centroids(self.lift(sample), lists, rng)
        self.first_ids, self.first = ids[:FIRST], sample[:FIRST]

    def lift(self, v: np.ndarray) -> np.ndarray:
        """Candidates with the added dimension, rotated."""
        rest = np.sqrt(np.maximum(self.top - (v * v).sum(axis=1), 0.0))
        return np.column_stack([v, rest]) @ self.rotation

    def lift_query(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation

    @staticmethod
    def _centroids(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
        lists = min(lists, len(x))
        centres = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(10):
            near = Index._nearest(x, centres, 1)[:, 0]
            count = np.bincount(near, minlength=lists)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
        return centres

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        out = []
        for lo in range(0, len(x), 1024):
            part = x[lo : lo + 1024]
            d = (centres * centres).sum(axis=1) - 2 * part @ centres.T
            out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
        return np.concatenate(out) if out else np.zeros((0, n), np.int64)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each query, nearest first."""
        return self._nearest(self.lift_query(q), self.centroids, n)

    def home(self, v: np.ndarray) -> np.ndarray:
        return self._nearest(self.lift(v), self.centroids, 1)[:, 0]

    def first_found(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """(ids, scores) of the best k of the first vectors, and the distance that they reach."""
        score = (self.first * q).sum(axis=1)
        other = np.flatnonzero(self.first_ids != query_id)
        top = other[_best(self.first_ids[other], score[other], k)]
        reached = self.top + float(q @ q) - 2 * score[top[-1]] if len(top) == k else np.inf
        return self.first_ids[top], score[top], max(reached, 0.0)


def scan(x: np.ndarray, q: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of ``x`` whose squared distance to ``q`` the tests leave at or under ``threshold``.

    After d of D columns the distance so far is about d/D of the whole; a row
    is left if it exceeds that share by more than chance (a factor of
    (1 + EPSILON / sqrt(d)) squared) allows.  The last test is exact but for rounding.
    """
    width = x.shape[1]
    alive = np.arange(len(x))
    so_far = np.zeros(len(x))
    slack = threshold * (1 + 1e-9) + 1e-9
    for lo in range(0, width, COLUMNS):
        hi = min(lo + COLUMNS, width)
        part = x[alive, lo:hi] if len(alive) < len(x) else x[:, lo:hi]
        part = part - q[lo:hi]
        so_far = so_far + np.einsum("ij,ij->i", part, part)
        limit = slack if hi == width else slack * hi / width * (1 + EPSILON / np.sqrt(hi)) ** 2
        keep = so_far <= limit
        alive, so_far = alive[keep], so_far[keep]
        if not len(alive):
            break
    return alive


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def build_index(vectors: DataFrame, lists: int | None = None) -> Index | None:
    """Index fitted on at most ``SAMPLE`` vectors drawn by hash; ``vectors`` from ``one_width``."""
    stats = vectors.agg(F.count(F.lit(1)), F.max("norm2"), F.max(F.size("v"))).first()
    if not stats[0]:
        return None
    drawn = vectors.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(SAMPLE).select("vec_id", "v").collect()  # bounded
    ids, sample = np.array([r[0] for r in drawn]), np.array([r[1] for r in drawn])
    count = lists or min(MAX_LISTS, max(1, round(stats[0] / LIST_ROWS)))
    return Index(stats[2], stats[1], ids, sample, count)


def _exact(vectors: DataFrame, queries: np.ndarray, own: np.ndarray, k: int, width: int) -> pd.DataFrame:
    """(n, v): true neighbours of a bounded set of queries.

    Each task keeps its k best of each query, and Spark ranks those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width))) for _ in queries]
        for batch in batches:
            ids, x = batch.column("vec_id").to_numpy(zero_copy_only=False), _matrix(batch.column("v"), width)
            for n, (q, me) in enumerate(zip(queries, own, strict=True)):
                other = np.flatnonzero(ids != me)
                score = (x @ q)[other]
                top = _best(ids[other], score, k)
                have = best[n]
                merged = [np.concatenate(p) for p in ((have[0], ids[other][top]), (have[1], score[top]), (have[2], x[other][top]))]
                keep = _best(merged[0], merged[1], k)
                best[n] = (merged[0][keep], merged[1][keep], merged[2][keep])
        for n, (ids, score, x) in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), n)), pa.array(ids), pa.array(score), pa.array(list(x), pa.list_(pa.float64()))],
                ["n", "vec_id", "score", "v"],
            )

    rows = vectors.select("vec_id", "v").mapInArrow(run, "n long, vec_id long, score double, v array<double>")
    order = W.partitionBy("n").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return ranked.select("n", "v").toPandas()  # at most FIT_QUERIES x k rows


def fit_probes(vectors: DataFrame, queries: DataFrame, index: Index, k: int, share: float = FITTED) -> int:
    """Lists to probe so that the sampled queries' true neighbours lie in them."""
    drawn = queries.orderBy(F.xxhash64("vec_id", F.lit(10)), "vec_id").limit(FIT_QUERIES).select("vec_id", "v").collect()
    if not drawn:
        return 1
    q = np.array([r[1] for r in drawn])
    truth = _exact(vectors, q, np.array([r[0] for r in drawn]), k, index.width)
    order = index.probes(q, len(index.centroids))
    place = np.argsort(order, axis=1)
    if not len(truth):
        return len(index.centroids)
    needed = np.sort(place[truth["n"].to_numpy(), index.home(np.array(truth["v"].tolist()))])
    return int(needed[int(np.ceil(share * len(needed))) - 1]) + 1


def search(vectors: DataFrame, every: int = 20, k: int = K, lists: int | None = None, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector whose vec_id is divisible by ``every``.

    score: the inner product on the original numbers in double precision;
    nearest first, ties to the smaller vec_id; a query is not its own
    candidate.  ``vectors``: vec_id, embedding.  Vectors that are null, empty,
    zero or hold null or non-finite numbers take no part; nor do null vec_ids,
    nor vectors of another width than most rows have (the smaller at a tie).
    Repeated rows are one vector; of different vectors with one vec_id the
    greatest counts.  Empty table: empty result.  Extra columns are not looked
    at.
    """
    spark = vectors.sparkSession
    clean = materialise(one_width(usable(vectors).where("vec_id IS NOT NULL")), "ads-vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    index = build_index(clean, lists)
    if index is None:
        return spark.createDataFrame([], schema)
    asked = clean.where(F.pmod("vec_id", F.lit(every)) == 0)
    probes = probes or fit_probes(clean, asked, index, k)
    width = index.width

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(index.home(_matrix(batch.column("v"), width)), pa.int32())],
                ["vec_id", "v", "list"],
            )

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, ids = _matrix(batch.column("v"), width), batch.column("vec_id").to_numpy(zero_copy_only=False)
            near = index.probes(q, probes)
            limits = np.array([index.first_found(i, x, k)[2] for i, x in zip(ids, q, strict=True)])
            rows = np.repeat(np.arange(len(q)), near.shape[1])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column("vec_id"), taken.column("v"), pa.array(np.repeat(limits, near.shape[1])), pa.array(near.ravel(), pa.int32())],
                ["query_id", "q", "threshold", "list"],
            )

    placed = clean.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<double>, list int")
    aimed = asked.select("vec_id", "v").mapInArrow(aim, "query_id long, q array<double>, threshold double, list int")
    placed = materialise(placed, "ads-lists")
    sizes = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))  # one row a list
    sizes = F.broadcast(materialise(sizes, "ads-sizes"))  # at most MAX_LISTS rows
    blocks = placed.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    # a long list's queries go to each of its blocks
    asks = aimed.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def scan_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, v = left["vec_id"].to_numpy(), np.array(left["v"].tolist())
            x = index.lift(v)
            q = np.array(right["q"].tolist())
            for me, own, turned, limit in zip(right["query_id"], q, index.lift_query(q), right["threshold"], strict=True):
                at = scan(x, turned, limit)
                at = at[ids[at] != me]
                score = (v[at] * own).sum(axis=1)
                top = _best(ids[at], score, k)
                if len(top):
                    out.append((me, ids[at][top], score[top]))
        return pd.DataFrame(out, columns=["query_id", "ids", "scores"])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("vec_id").to_numpy(zero_copy_only=False)
            found = [index.first_found(i, x, k) for i, x in zip(own, _matrix(batch.column("v"), width), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                ["query_id", "ids", "scores"],
            )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, scores = np.concatenate(pdf["ids"].tolist()), np.concatenate(pdf["scores"].tolist())
        ids, once = np.unique(ids, return_index=True)
        scores = scores[once]
        top = _best(ids, scores, k)
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(top) + 1), "vec_id": ids[top], "score": scores[top]})

    found = (
        blocks.select("list", "block", "vec_id", "v")
        .groupBy("list", "block")
        .cogroup(asks.select("list", "block", "query_id", "q", "threshold").groupBy("list", "block"))
        .applyInPandas(scan_block, "query_id long, ids array<long>, scores array<double>")
    )
    # the vectors behind the first thresholds are candidates too: no query stays short of k
    first = asked.select("vec_id", "v").mapInArrow(start, "query_id long, ids array<long>, scores array<double>")
    return found.unionByName(first).groupBy("query_id").applyInPandas(merge, schema)
