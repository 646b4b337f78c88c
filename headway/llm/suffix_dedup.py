"""Substring dedup with prefix-partitioned suffix trees over words.

A repeat is a run of at least 50 words.  Not every suffix is needed to find it:
of the 43 eight-word prefixes that start within a window of 50 words, the one
with the least hash is the window's anchor, so equal windows have equal
anchors.  Suffixes are grouped by the prefix at their anchor; prefixes that
only one document has cannot be part of a repeat and are dropped.  Groups are
packed into parts of bounded size; each part ranks all its suffixes by ever
longer prefixes (1, 2, 4 ... 50 words), which gives the nodes of its suffix
trees at depth 50, and every node knows the least document below it.

A prefix of more than ``HOT`` suffixes is split by the longest prefix there
is, the 50 words themselves, which Spark groups without bound.

Documents of equal words are one sequence: all but the least doc_id repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.store import materialise
from headway.llm.words import gram_hashes, mix, rows_of, words_of

WINDOW = 50
GRAM = 8
REACH = WINDOW - GRAM  # starts of a window before its anchor
#: Suffix groups of one part, and suffixes that one prefix may have in a part.
PART = 20_000
HOT = 50_000
#: Anchors of a text that are laid out at once.
BATCH = 8_192
_NONE = (1 << 63) - 1
_PLACE = np.uint64((1 << 28) - 1)


def anchors(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of the anchors of all windows that lie within one row."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    grams = gram_hashes(hashes, GRAM)
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= REACH + 1:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[REACH + 1 - span :][:n])
    at = (low & _PLACE).astype(np.int64)[rows[:n] == rows[WINDOW - 1 :]]
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _sequence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for w in words_of(text):
            n = w.last - w.first
            rows = rows_of(w.bounds)
            at = np.unique(anchors(w.hashes, rows))
            cuts = np.searchsorted(at, w.bounds)
            keys = gram_hashes(w.hashes, GRAM)[at].view(np.int64) if len(at) else np.zeros(0, np.int64)
            offsets = pa.array(cuts, pa.int32())
            second = mix(w.hashes)
            sequence, sha = [], []
            for r in range(n):
                own = slice(w.bounds[r], w.bounds[r + 1])
                size = own.stop - own.start
                if size:
                    sequence.append(gram_hashes(w.hashes[own], size).tobytes() + gram_hashes(second[own], size).tobytes())
                else:
                    sequence.append(b"")
                body = text[w.first + r].as_buffer()
                sha.append(hashlib.sha256(b" ".join(bytes(body).split() if body is not None else ())).hexdigest())
            part = batch.slice(w.first, n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("node"),
                    pa.array(sequence, pa.binary()),
                    pa.array(np.diff(w.bounds), pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys)),
                    pa.ListArray.from_arrays(offsets, pa.array(at - np.repeat(w.bounds[:-1], np.diff(cuts)), pa.int32())),
                ],
                ["doc_id", "node", "sequence", "n_words", "sha", "keys", "places"],
            )


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor with its words from REACH before to WINDOW after it.

    Neighbouring anchors of equal words (one word said over and over) are one
    row, from ``place`` to ``place_last``.
    """
    for batch in batches:
        for r in range(batch.num_rows):
            (w,) = words_of(batch.column("text").slice(r, 1))
            every = np.unique(np.array(batch.column("places")[r].as_py(), np.int64))
            for lo in range(0, len(every), BATCH):
                places = every[lo : lo + BATCH]
                near = places[:, None] + np.arange(-REACH, WINDOW)
                inside = (near >= 0) & (near < len(w.hashes))
                words = np.where(inside, w.hashes[np.clip(near, 0, len(w.hashes) - 1)], np.uint64(0))
                head = np.ones(len(places), bool)
                head[1:] = (places[1:] != places[:-1] + 1) | (words[1:] != words[:-1]).any(axis=1)
                last = places[np.append(head[1:], True)]
                places, words = places[head], np.ascontiguousarray(words[head])
                size, width = len(places), words.shape[1] * 8
                offsets = pa.py_buffer((np.arange(size + 1) * width).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("sequence")[r].as_py()] * size, pa.binary()),
                        pa.array(np.full(size, batch.column("doc")[r].as_py(), np.int64)),
                        pa.array(gram_hashes(w.hashes, GRAM)[places].view(np.int64)),
                        pa.array(places),
                        pa.array(last),
                        pa.array(np.full(size, len(w.hashes), np.int64)),
                        pa.Array.from_buffers(pa.binary(), size, [None, offsets, pa.py_buffer(words.tobytes())]),
                    ],
                    ["sequence", "doc", "key", "place", "place_last", "n_words", "words"],
                )


def node_ranks(words: np.ndarray) -> np.ndarray:
    """Rank at depth WINDOW of the suffix at each column of ``words`` (suffix groups x words).

    Two cells get one rank exactly if their WINDOW words are equal: prefixes
    double in length, each rank being that of a pair of shorter ranks.
    """
    _, flat = np.unique(words, return_inverse=True)
    rank = flat.reshape(words.shape).astype(np.int64)
    span = 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        pair = rank[:, : rank.shape[1] - step] * (int(rank.max(initial=0)) + 1) + rank[:, step:]
        _, flat = np.unique(pair, return_inverse=True)
        rank = flat.reshape(pair.shape).astype(np.int64)
        span += step
    return rank


def _runs(covered: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix group, start, end) of the words under each run of covered windows."""
    edge = np.diff(np.pad(covered.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return row, place[row] - REACH + first, place[row] - REACH + last - 1 + WINDOW


def _part_repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    words = np.frombuffer(b"".join(pdf["words"]), np.uint64).reshape(len(pdf), REACH + WINDOW)
    place, size = pdf["place"].to_numpy(np.int64), pdf["n_words"].to_numpy(np.int64)
    doc = pdf["doc"].to_numpy(np.int64)
    rank = node_ranks(words)
    start = place[:, None] - REACH + np.arange(rank.shape[1])
    valid = (start >= 0) & (start + WINDOW <= size[:, None])
    order = np.argsort(rank[valid], kind="stable")
    docs = np.broadcast_to(doc[:, None], rank.shape)[valid]
    covered = np.zeros(rank.shape, bool)
    if len(order):
        sorted_rank = rank[valid][order]
        head = np.flatnonzero(np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]]))
        least = np.repeat(np.minimum.reduceat(docs[order], head), np.diff(np.append(head, len(order))))
        hit = np.zeros(len(order), bool)
        hit[order] = least < docs[order]
        covered[valid] = hit
    row, first, last = _runs(covered, place)
    last += (pdf["place_last"].to_numpy(np.int64) - place)[row]
    out = pd.DataFrame({"sequence": pdf["sequence"].to_numpy()[row], "first": first, "last": last})
    return out.drop_duplicates()


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every whole window around each anchor, by the hash of its words.

    Equal windows that start next to each other are one row with the first and
    last start, and windows that neighbouring anchors share come once.
    """
    for batch in batches:
        n = batch.num_rows
        words = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint64).reshape(n, REACH + WINDOW)
        place = batch.column("place").to_numpy()
        start = place[:, None] - REACH + np.arange(REACH + 1)
        valid = (start >= 0) & (start + WINDOW <= batch.column("n_words").to_numpy()[:, None])
        hashes = np.stack([gram_hashes(x, WINDOW) for x in words]) if n else np.zeros((0, REACH + 1), np.uint64)
        row, _ = np.nonzero(valid)
        own = batch.column("sequence").dictionary_encode().indices.to_numpy()[row].astype(np.int64) << 40
        first, window = own + start[valid], hashes[valid].view(np.int64)
        last = first + (batch.column("place_last").to_numpy() - place)[row]
        order = np.argsort(first, kind="stable")
        row, own, first, last, window = row[order], own[order], first[order], last[order], window[order]
        head = np.ones(len(row), bool)
        head[1:] = (first[1:] > np.maximum.accumulate(last)[:-1] + 1) | (own[1:] != own[:-1]) | (window[1:] != window[:-1])
        at = np.flatnonzero(head)
        last = np.maximum.reduceat(last, at) if len(at) else last
        taken = batch.take(pa.array(row[at]))
        yield pa.RecordBatch.from_arrays(
            [taken.column("sequence"), taken.column("doc"), pa.array(first[at] - own[at]), pa.array(last - own[at]), pa.array(window[at])],
            ["sequence", "doc", "first", "last", "window"],
        )


def _hot_repeats(hot: DataFrame) -> DataFrame:
    windows = materialise(
        hot.mapInArrow(_window_rows, "sequence binary, doc long, first long, last long, window long"), "suffix-windows"
    )
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    found = windows.join(least, "window").where("least < doc")
    return found.select("sequence", "first", (F.col("last") + WINDOW).alias("last")).distinct()


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, sha = [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = text.as_py().encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for span in spans.as_py():
                gone[span["first"]] += 1
                gone[span["last"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("sequence"), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], ["sequence", "part_removed", "part_sha"]
        )


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, texts, spans): all rows with their sequence; the texts that hold
    candidates, one a sequence; the repeated stretches (sequence, first, last)."""
    doc = F.coalesce(F.col("doc_id"), F.lit(_NONE))
    node = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    own = docs.select("doc_id", node.alias("node"), "text")
    rows = materialise(
        own.mapInArrow(
            _sequence_rows,
            "doc_id long, node binary, sequence binary, n_words long, sha string, keys array<long>, places array<int>",
        ),
        "suffix-rows",
    )
    firsts = materialise(
        rows.where(F.col("n_words") >= WINDOW)
        .groupBy("sequence")
        .agg(F.min(F.struct(doc.alias("doc"), "node")).alias("first"), F.first("keys").alias("keys"), F.first("places").alias("places"))
        .select("sequence", "first.doc", "first.node", "keys", "places"),
        "suffix-firsts",
    )
    prefixes = firsts.select("sequence", "doc", "node", F.explode(F.arrays_zip("keys", "places")).alias("x")).select(
        "sequence", "doc", "node", F.col("x.keys").alias("key"), F.col("x.places").alias("place")
    )
    shared = materialise(
        prefixes.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("n")).where("a < b").select("key", "n"),
        "suffix-shared",
    )
    wanted = (
        prefixes.join(shared, "key").groupBy("sequence", "doc", "node").agg(F.collect_list("place").alias("places"))
    )  # a document's own anchors
    texts = materialise(
        own.withColumnRenamed("node", "own_node")
        .withColumn("own_doc", doc)
        .join(wanted, (F.col("own_doc") == F.col("doc")) & (F.col("own_node") == F.col("node")))
        .select("sequence", "doc", "node", "places", "text")
        .dropDuplicates(["doc", "node"]),
        "suffix-texts",
    )
    suffixes = texts.mapInArrow(_suffix_rows, "sequence binary, doc long, key long, place long, place_last long, n_words long, words binary")
    size = shared.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    hot_keys = shared.where(F.col("n") > HOT).select("key")
    usual = suffixes
    if size[1] > HOT:
        suffixes = materialise(suffixes, "suffix-groups")
        usual = suffixes.join(hot_keys, "key", "left_anti")
    parts = max(1, -(-int(size[0]) // PART))
    spans = (
        usual.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(_part_repeats, "sequence binary, first long, last long")
    )
    if size[1] > HOT:
        spans = spans.unionByName(_hot_repeats(suffixes.join(hot_keys, "key", "left_semi")))
    return rows, texts, spans


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Removed are the words under any window of 50 consecutive words that also
    starts in a document of smaller doc_id.  Windows are judged on the input.

    Null text: no words.  Null doc_id: larger than all others, and not smaller
    than another null.  Rows of one doc_id do not remove from each other.
    Texts of fewer than 50 words stay whole.  Empty table: empty result.  Extra
    columns are not looked at.
    """
    rows, texts, spans = repeated_spans(docs)
    merged = spans.groupBy("sequence").agg(F.collect_list(F.struct("first", "last")).alias("spans"))  # a document's own
    parts = texts.join(merged, "sequence").select("sequence", "text", "spans").mapInArrow(
        _kept_rows, "sequence binary, part_removed long, part_sha string"
    )
    doc = F.coalesce(F.col("doc_id"), F.lit(_NONE))
    least = rows.groupBy("sequence").agg(F.min(doc).alias("least")).join(parts, "sequence", "left")
    whole = (doc > F.col("least")) & (F.col("n_words") >= WINDOW)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        rows.select("doc_id", "sequence", "n_words", "sha")
        .join(least, "sequence")
        .select(
            "doc_id",
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("part_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(whole, F.lit(nothing)).otherwise(F.coalesce("part_sha", "sha")).alias("kept_sha256"),
        )
    )


ORACLE_SUFFIX = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)
), least AS (
  SELECT win, min(doc_id) AS doc_id FROM windows GROUP BY win
), gone AS (
  SELECT DISTINCT w.doc_id, w.i + k AS place
  FROM windows w JOIN least l ON l.win = w.win AND l.doc_id < w.doc_id, range(0, 50) t(k)
), flagged AS (
  SELECT u.doc_id, u.place, u.word, g.place IS NOT NULL AS removed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d) u
  LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.place = u.place
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(f.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(f.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, sum(removed::INT) AS n, string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT removed) AS kept FROM flagged GROUP BY doc_id
) f ON f.doc_id = d.doc_id
"""
