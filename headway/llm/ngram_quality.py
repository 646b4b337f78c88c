"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

A text gives four families of hashed features: words, word pairs, word shapes
(letters folded to case classes, runs folded to one) and shape pairs; a pair of
equal words has a shape of its own.  A feature's value is its share of its
family, so long and short texts weigh alike, and a text's score is one sparse
dot product.

Training is bounded: at most ``max_train`` labelled rows are drawn by hash,
dealt into ``shards`` groups, each group runs follow-the-regularised-leader
updates over its rows, and the weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.store import materialise
from headway.llm.words import Words, mix, powers, rows_of, words_of

BITS = 18
FAMILIES = 4
#: What a family's shares are multiplied by: lexical families lightly.
SCALES = np.array([2.0, 2.0, 6.0, 6.0])

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def _shapes(w: Words) -> np.ndarray:
    """Hash of each word's shape."""
    b = w.data
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    shape = _SHAPE[b]
    after_c3 = np.zeros(len(b), bool)
    after_c3[1:] = b[:-1] == 0xC3
    shape[after_c3 & (b >= 0x80) & (b <= 0x9E)] = ord("A")
    kept = np.ones(len(b), bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[w.starts] = True
    lead = b == 0xC3  # the letter's class comes with the next byte
    kept &= ~lead
    kept[1:] |= lead[:-1] & ((shape[1:] != np.concatenate([[0], shape[:-2]])) | np.isin(np.arange(len(b) - 1), w.starts))
    order = np.cumsum(kept) - 1
    sums = np.zeros(len(b) + 1, np.uint64)
    term = np.where(kept, mix(shape.astype(np.uint64) + np.uint64(1)), np.uint64(0))
    np.cumsum(term * powers(_BASE, len(b))[np.maximum(order, 0)], out=sums[1:])
    first = np.maximum(order[w.starts] + ~kept[w.starts], 0)
    return mix((sums[w.ends] - sums[w.starts]) * powers(_INV, len(b) + 1)[first])


def features(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every occurrence, by family."""
    rows = rows_of(w.bounds)
    shapes = _shapes(w)
    mask = np.uint64((1 << BITS) - 1)
    salt = [np.uint64(x) for x in (0x51, 0x52, 0x53, 0x54, 0x55)]
    out = [(rows, mix(w.hashes + salt[0]) & mask)]
    pair = rows[1:] == rows[:-1]
    left, right = w.hashes[:-1][pair], w.hashes[1:][pair]
    out.append((rows[1:][pair], mix(mix(left + salt[1]) ^ right) & mask))
    out.append((rows, mix(shapes + salt[2]) & mask))
    both = mix(mix(shapes[:-1][pair] + salt[3]) ^ shapes[1:][pair])
    both = np.where(left == right, salt[4], both)
    out.append((rows[1:][pair], mix(both) & mask))
    return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def margins(w: Words, weights: np.ndarray) -> np.ndarray:
    """weights . features of each row; weights[-1] is the constant."""
    n = len(w.bounds) - 1
    total = np.full(n, weights[-1])
    for scale, (rows, index) in zip(SCALES, features(w), strict=True):
        count = np.bincount(rows, minlength=n)
        total += scale * np.bincount(rows, weights[index], minlength=n) / np.maximum(count, 1)
    return total


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in words_of(batch.column("text")):
            n = w.last - w.first
            index: list[list[np.ndarray]] = [[] for _ in range(n)]
            value: list[list[np.ndarray]] = [[] for _ in range(n)]
            for scale, (rows, feature) in zip(SCALES, features(w), strict=True):
                cuts = np.searchsorted(rows, np.arange(n + 1))
                for r in range(n):
                    own, count = np.unique(feature[cuts[r] : cuts[r + 1]], return_counts=True)
                    index[r].append(own.astype(np.int32))
                    value[r].append((scale / max(count.sum(), 1) * count).astype(np.float32))
            part = batch.slice(w.first, n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("draw"),
                    part.column("label"),
                    pa.array([np.concatenate(x).tobytes() for x in index], pa.binary()),
                    pa.array([np.concatenate(x).tobytes() for x in value], pa.binary()),
                ],
                ["draw", "label", "index", "value"],
            )


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    epochs: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
) -> np.ndarray:
    """Weights after follow-the-regularised-leader updates, example by example."""
    size = (1 << BITS) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for index, value, label in examples:
            zi, ni = z[index], n[index]
            wi = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
            g = (_logistic(np.array(wi @ value)) - label) * value
            z[index] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi
            n[index] += g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    return w


def _train_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("draw")
    examples = []
    for index, value, label in zip(pdf["index"], pdf["value"], pdf["label"], strict=True):
        # features of two families that fall into one slot add up
        slots, at = np.unique(np.frombuffer(index, np.int32), return_inverse=True)
        sums = np.bincount(at, np.frombuffer(value, np.float32), minlength=len(slots))
        examples.append((np.append(slots, 1 << BITS), np.append(sums, 1.0), int(label)))
    w = ftrl(examples)
    found = np.flatnonzero(w)
    return pd.DataFrame({"slot": found.astype(np.int64), "weight": w[found], "rows": len(examples)})


def train(docs: DataFrame, labels: DataFrame, max_train: int = 8000, shards: int = 4) -> np.ndarray:
    """Weights learnt from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1).

    At most ``max_train`` distinct texts take part, drawn by hash.  Labels that
    are null or not 0/1 are left out; of several labels of a doc_id the lowest
    counts.  Without examples all weights are 0 (every score 0.5).
    """
    chosen = (
        labels.where("label IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id")
        .limit(max_train)
    )
    # at most max_train rows of two numbers
    labelled = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(materialise(chosen, "quality-labels")), "doc_id")
        .withColumn("draw", F.xxhash64("doc_id", "text"))
    )
    last = labelled.select("draw").distinct().orderBy("draw").limit(max_train).agg(F.max("draw")).first()[0]
    if last is None:
        return np.zeros((1 << BITS) + 1)
    rows = labelled.where(F.col("draw") <= F.lit(last)).select("draw", "label", "text")
    sparse = rows.mapInArrow(_sparse_rows, "draw long, label int, index binary, value binary")
    learnt = materialise(
        sparse.dropDuplicates(["draw"])
        .withColumn("shard", F.pmod(F.col("draw"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(_train_shard, "slot long, weight double, rows long")
        .groupBy("slot")
        .agg(F.sum(F.col("weight") * F.col("rows")).alias("weight")),
        "quality-weights",
    )
    total = rows.select("draw").distinct().count()
    weights = np.zeros((1 << BITS) + 1)
    for slot, weight in learnt.collect():  # at most 2**18 + 1 rows
        weights[slot] = weight / total
    return weights


def score(docs: DataFrame, weights: np.ndarray, id_columns: list[str]) -> DataFrame:
    """``id_columns`` of every row of ``docs`` with ``score`` (0 to 1) of its whole text.

    Null text counts as empty; an empty text has the score of the constant.
    """
    weights = weights.astype(np.float64)
    kept = docs.select(*id_columns, "text")
    schema = kept.drop("text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_logistic(margins(w, weights)) for w in words_of(batch.column("text"))]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in id_columns), scores], [*id_columns, "score"])

    return kept.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_train: int = 8000) -> DataFrame:
    """Rows of ``docs`` with a score of at least ``threshold``, all columns as they are."""
    weights = train_on_known(docs, labels, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_logistic(margins(w, weights)) >= threshold for w in words_of(batch.column("text"))]
            yield batch.filter(pa.array(np.concatenate(found) if found else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def is_held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_known(docs: DataFrame, labels: DataFrame, max_train: int) -> np.ndarray:
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~is_held_out())
    return train(docs.select("doc_id", "text"), known, max_train)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_train: int = 8000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns from labelled rows whose crc32(doc_id as text) mod 4 is not 2.  Null
    doc_id: scored, never held out, has no label.  Repeated rows: each scored.
    Empty tables: empty result.  Extra columns are not looked at.
    """
    weights = train_on_known(docs, labels, max_train)
    return score(docs.select("doc_id", "text"), weights, ["doc_id"]).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
