"""Line dedup: range-partitioned line hashes, streamed in order, keep bitmaps out.

Each long line becomes (hash of its key, document, position).  The rows are
range-partitioned and sorted by hash, document (largest first) and position, so
that a line found in a third of all documents spreads over as many partitions
as its rows fill.  One pass streams each partition: the first document of a
key keeps its lines, later ones lose theirs once the key is known to be in
enough documents.  Only the keys at the two ends of a partition can lie in
several partitions; their rows are settled by totals of a row or two a
partition.  What is dropped comes back as one compressed keep bitmap a
document, not as text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.store import materialise

#: Code points that a key needs, and documents that must hold it.
MIN_CHARS = 40
MIN_DOCS = 5
#: Stands for a null doc_id: one document, smaller than all others.
NO_DOC = -(1 << 63)
#: Bytes stripped at both ends of a line.
_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Lines of one output batch.
BATCH = 1 << 16

_KEYS = "h1 long, h2 long, doc long, text_key long, pos int"
_FOUND = "h1 long, h2 long, doc long, text_key long, pos int, open boolean"


def _doc(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_DOC))


def _texts(docs: DataFrame) -> DataFrame:
    """Text (null as empty) with its document and a key that tells apart rows of one doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(_doc(F.col("doc_id")).alias("doc"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _line_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, places = [], [], []
            for row, text in enumerate(batch.column("text")):
                for pos, line in enumerate(bytes(text.as_buffer()).split(b"\n")):
                    key = line.strip(_BLANK)
                    # bytes are at least as many as code points
                    if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key.translate(_LOWER)))
                        rows.append(row)
                        places.append(pos)
                if len(rows) >= BATCH:
                    yield _key_batch(batch, digests, rows, places)
                    digests, rows, places = [], [], []
            if rows:
                yield _key_batch(batch, digests, rows, places)

    return run


def _key_batch(batch: pa.RecordBatch, digests: list[bytes], rows: list[int], places: list[int]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(halves[:, 0])),
            pa.array(np.ascontiguousarray(halves[:, 1])),
            batch.column("doc").take(at),
            batch.column("text_key").take(at),
            pa.array(places, pa.int32()),
        ],
        ["h1", "h2", "doc", "text_key", "pos"],
    )


class _Group:
    """The key that a stream stands in, and what has been seen of it."""

    def __init__(self, key: bytes, first: bool):
        self.key = key
        self.first = first  # the partition's first key may have begun in an earlier partition
        self.docs: list[int] = []  # its first distinct documents, as many as decide
        self.held: list[np.ndarray] = []  # rows seen before the decision


def _stream(min_docs: int):
    """Rows to drop, and rows (``open``) of keys that may lie in several partitions.

    Input: one partition, sorted by key, document (largest first) and position.
    Of a key that goes on after the partition's end, its first documents come
    out as open rows too (position -1 where their lines are settled), so that
    the open rows of a key tell whether it is in enough documents and in which
    one it stays.
    """

    def feed(group: _Group, rows: np.ndarray) -> np.ndarray:
        """Take more rows of the key; those that are sure to go come back."""
        if len(group.docs) < min_docs:
            heads = rows[np.concatenate([[True], rows[1:, 2] != rows[:-1, 2]])]
            group.docs += [d for d in heads[: min_docs + 1, 2].tolist() if not group.docs or d < group.docs[-1]]
            group.held.append(rows)
            if len(group.docs) < min_docs:
                return rows[:0]
            rows = np.concatenate(group.held)
            del group.docs[min_docs:]
        return rows[rows[:, 2] != group.docs[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)], axis=1)
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            starts = np.append(np.flatnonzero(new), len(rows)).tolist()
            sure, unsure = [rows[:0]], [rows[:0]]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if s and e < len(rows) and e - s < min_docs:
                    continue  # a whole key in too few documents
                part, key = rows[s:e], rows[s, :2].tobytes()
                if group is None or group.key != key:
                    group = _Group(key, first=group is None)
                if group.first:
                    unsure.append(part)
                else:
                    sure.append(feed(group, part))
            yield _found_batch(np.concatenate(sure), False)
            yield _found_batch(np.concatenate(unsure), True)
        if group is not None and not group.first:
            rest = np.concatenate(group.held)
            if len(group.docs) == min_docs:
                rest = rest[np.concatenate([[True], rest[1:, 2] != rest[:-1, 2]])].copy()
                rest[:, 4] = -1
            yield _found_batch(rest, True)

    return run


def _found_batch(rows: np.ndarray, is_open: bool) -> pa.RecordBatch:
    cols = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array(rows[:, 4].astype(np.int32)), pa.array(np.full(len(rows), is_open))],
        ["h1", "h2", "doc", "text_key", "pos", "open"],
    )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for gone in batch.column("gone"):
            places = gone.values.to_numpy()
            bits = np.ones(int(places.max()) // 8 * 8 + 8, bool)  # whole bytes: the rest of the last stays
            bits[places] = False
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("text_key"), pa.array(keep, pa.binary())], ["doc", "text_key", "keep"]
        )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, text_key, keep) of every text that loses a line.

    ``keep`` is a zlib-compressed bitmap of the text's lines, 1 for a line that
    stays; lines after its last bit stay.  ``doc`` is the doc_id (``NO_DOC`` if
    null), ``text_key`` Spark's xxhash64 of the text.
    """
    keys = _texts(docs).mapInArrow(_line_keys(min_chars), _KEYS)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("text_key"), F.col("pos")]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialise(ranged.mapInArrow(_stream(min_docs), _FOUND), "lines-found")
    # Keys at the ends of partitions: at most two a partition, which bounds the broadcast.
    totals = (
        found.where("open")
        .groupBy("h1", "h2")
        .agg(F.countDistinct("doc").alias("docs"), F.max("doc").alias("stays"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    settled = found.where("open and pos >= 0").join(F.broadcast(totals), ["h1", "h2"]).where("doc <> stays")
    gone = found.where("not open").select("doc", "text_key", "pos").unionByName(settled.select("doc", "text_key", "pos"))
    each = gone.groupBy("doc", "text_key").agg(F.collect_set("pos").alias("gone"))  # as many as the text has lines
    return each.mapInArrow(_bitmaps, "doc long, text_key long, keep binary")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, keep in zip(batch.column("text"), batch.column("keep"), strict=True):
            body = bytes(text.as_buffer())
            n_lines.append(body.count(b"\n") + 1)
            if not keep.is_valid:
                n_dropped.append(0)
                texts.append(body)
                continue
            lines = body.split(b"\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8))
            gone = set(np.flatnonzero(bits == 0).tolist())
            kept = [line for i, line in enumerate(lines) if i not in gone]
            n_dropped.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_text"],
        )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

    A line's key is the line without white space at its ends, A-Z lowered.  Keys
    of at least ``min_chars`` code points that at least ``min_docs`` documents
    hold lose all their lines but those of the largest doc_id holding it.

    Null or empty text: one empty line, which stays.  Null doc_id: all such rows
    count as one document, smaller than all others.  Rows of one doc_id count as
    one document; each gets its own row.  A line repeated within a document goes
    or stays with all its repeats.  An empty table gives an empty result.  Other
    columns of ``docs`` are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", _doc(F.col("doc_id")).alias("doc"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    joined = rows.join(keep_bitmaps(docs, min_chars, min_docs), ["doc", "text_key"], "left")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "keep").mapInArrow(
        _kept, f"doc_id {doc_type}, n_lines long, n_dropped long, kept_text string"
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of ``drop_repeated_lines``."""
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_LINES = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
repeated AS (
    SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.stays AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, cast(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
