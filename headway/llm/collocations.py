"""Phrase collocations: Misra-Gries survivors per hash partition, then exact counts.

Words are counted exactly by Spark.  Longer phrases are found in two passes for
each length.  First pass: every phrase whose parts may be frequent goes, as a
hash, to one of many hash partitions; tasks combine what they have read into one
mergeable summary a partition, and a partition merges its summaries into at most
``mass / threshold + 1`` counters by Misra and Gries' rule, so that no phrase of
the threshold's count can be missing among the survivors.  Second pass: the
texts are read again, and phrases that survive (or share a bit of the survivors'
bitmap, whose size is bounded) are counted exactly, again by hash partition.

The number of partitions follows the counted mass, so a partition's summaries
stay within a task's memory.  A phrase is known by the 64-bit hashes of its
words and language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from headway.llm.store import materialise
from headway.llm.words import _LOWER, _VALUES, SLICE_BYTES, _hash_words, gram_hashes, mix, row_slices, string_buffers

#: Occurrences that a candidate needs, and rows of a language in the report.
MIN_COUNT = 10
TOP = 2000
#: A phrase goes if a longer one that holds it has this share (percent) of its count.
SHARE = 50
SCALE = 1_000_000
#: Phrase occurrences of one hash partition, about.
MASS = 1 << 21
#: Distinct phrases that a task holds before it sends them on.
HELD = 1 << 21
#: Bits of a survivors' bitmap: at most 32 MiB are broadcast.
MAX_BITS = 1 << 28
UNKNOWN = "und"

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\n\x0b\x0c\r")] = True


# ── words and phrases of a batch ─────────────────────────────────────────────


class _Tokens:
    """Words of some consecutive rows: bytes, ends, hashes, row and piece of each word."""

    def __init__(self, data: np.ndarray, rows: np.ndarray):
        n = len(data)
        solid = ~(_BLANK | _STOP)[data]
        begin, finish = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        finish[:-1] &= ~solid[1:]
        inner = rows[(rows > 0) & (rows < n)]
        begin[inner] = solid[inner]
        finish[inner - 1] = solid[inner - 1]
        self.data, self.starts, self.ends = data, np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.row = np.searchsorted(rows, self.starts, "right") - 1
        stops = np.flatnonzero(_STOP[data])
        self.piece = np.searchsorted(stops, self.starts)
        self.hashes = _hash_words(data, self.starts, self.ends, _VALUES[_LOWER])

    def together(self, k: int) -> np.ndarray:
        """Whether the k words from each position lie in one piece."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        last = slice(k - 1, None)
        return (self.row[:n] == self.row[last]) & (self.piece[:n] == self.piece[last])


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[_Tokens, np.ndarray, list[str]]]:
    """Words of slices of a batch, the language number of each word, and the languages."""
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    lang_of = langs.indices.to_numpy(zero_copy_only=False)
    offsets, data = string_buffers(batch.column("text"))
    for i, j in row_slices(offsets, SLICE_BYTES):
        base = int(offsets[i])
        t = _Tokens(data[base : int(offsets[j])], offsets[i : j + 1] - base)
        if len(t.starts):
            yield t, lang_of[i:j][t.row], names


def _lang_salt(names: list[str]) -> np.ndarray:
    """A 64-bit number for each language."""
    return np.array([zlib.crc32(x.encode()) | zlib.adler32(x.encode()) << 32 for x in names], np.uint64)


def _salted(grams: np.ndarray, lang: np.ndarray, names: list[str]) -> np.ndarray:
    """Phrase hashes that differ from language to language."""
    return mix(grams ^ mix(_lang_salt(names))[lang])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (lang, word hash, word, f), combined within slices."""
    for batch in batches:
        for t, lang, names in _tokens(batch):
            for k, name in enumerate(names):
                at = np.flatnonzero(lang == k)
                if not len(at):
                    continue
                found, first, n = np.unique(t.hashes[at], return_index=True, return_counts=True)
                spots = at[first]
                body = _LOWER[t.data].tobytes()
                words = [body[s:e] for s, e in zip(t.starts[spots].tolist(), t.ends[spots].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(found), pa.string()),
                        pa.array(found.view(np.int64)),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array(n, pa.int64()),
                    ],
                    ["lang", "w", "word", "f"],
                )


# ── bitmaps of what may be frequent ──────────────────────────────────────────


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit that a key's upper bits name is set."""
    spot = keys >> np.uint64(64 - (len(bits) * 8 - 1).bit_length())
    return (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _bitmap(keys: DataFrame, column: str, rows: int) -> np.ndarray:
    """Bitmap of a column of 64-bit hashes, at most MAX_BITS: about 16 bits a key while that lasts.

    It has no false negatives at any size; what the driver gets is the bitmap, in chunks."""
    size = min(MAX_BITS, max(1 << 16, 1 << (16 * max(1, rows) - 1).bit_length()))
    chunk = min(size, 1 << 22)  # bits of one chunk, the unit that a task builds
    shift = 64 - (size - 1).bit_length()
    spots = keys.select(F.shiftrightunsigned(F.col(column), shift).alias("spot"))
    chunks = spots.select(F.floor(F.col("spot") / chunk).alias("chunk"), (F.col("spot") % chunk).alias("bit"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(chunk, bool)
        bits[group["bit"].to_numpy()] = True
        body = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "body": [body]})

    out = np.zeros(size // 8, np.uint8)
    for r in chunks.groupBy("chunk").applyInPandas(build, "chunk long, body binary").collect():
        out[r.chunk * chunk // 8 : (r.chunk + 1) * chunk // 8] = np.frombuffer(zlib.decompress(bytes(r.body)), np.uint8)
    return out


# ── first pass: Misra-Gries ──────────────────────────────────────────────────


def _combined(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def merge_summaries(parts: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries merge of (sorted keys, counts): at most ``capacity`` counters, and what each may lack.

    Counters are added; where more are left than fit, the count of the first
    that does not fit is taken from all, and those at nothing go.  Every key's
    true count is at most its counter (none: 0) plus what was taken, and that
    is at most the mass divided by ``capacity + 1``."""
    keys, counts, taken = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    for more_keys, more_counts in parts:
        keys, counts = _combined(np.concatenate([keys, more_keys]), np.concatenate([counts, more_counts]))
        if len(keys) > capacity:
            least = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            counts = counts - least
            taken += least
            keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts, taken


def _allowed(t: _Tokens, lang: np.ndarray, names: list[str], k: int, words: np.ndarray, shorter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of k-word phrases whose parts may be frequent, and their hashes."""
    ok = t.together(k)
    if not len(ok):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    common = _has(words, _salted(t.hashes, lang, names))
    for j in range(k):
        ok &= common[j : j + len(ok)]
    if shorter is not None:
        part = _has(shorter, _salted(gram_hashes(t.hashes, k - 1), lang[: len(t.hashes) - k + 2], names))
        for j in range(2):
            ok &= part[j : j + len(ok)]
    at = np.flatnonzero(ok)
    return at, _salted(gram_hashes(t.hashes, k)[at], lang[at], names)


def _summaries(k: int, bits: int, words, shorter):
    """Exact counts of the phrases a task has read, one summary a hash partition.

    The upper ``bits`` of a hash are its partition, the next 32 its key."""

    def flush(held: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = _combined(np.concatenate(held), np.concatenate(counts))
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
        low = (keys >> np.uint64(32 - bits)).astype(np.uint32)
        rows = [p for p in range(1 << bits) if cuts[p + 1] > cuts[p]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int32()),
                pa.array([int(n[cuts[p] : cuts[p + 1]].sum()) for p in rows], pa.int64()),
                pa.array([low[cuts[p] : cuts[p + 1]].tobytes() for p in rows], pa.binary()),
                pa.array([zlib.compress(n[cuts[p] : cuts[p + 1]].astype(np.uint32).tobytes(), 1) for p in rows], pa.binary()),
            ],
            ["part", "mass", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, size = [], [], 0
        for batch in batches:
            for t, lang, names in _tokens(batch):
                _, grams = _allowed(t, lang, names, k, words.value, shorter.value if shorter else None)
                keys, n = np.unique(grams, return_counts=True)
                held.append(keys)
                counts.append(n.astype(np.int64))
                size += len(keys)
                if size > HELD:
                    keys, n = _combined(np.concatenate(held), np.concatenate(counts))
                    held, counts, size = [keys], [n], len(keys)
                    if size > HELD // 2:
                        yield flush(held, counts)
                        held, counts, size = [], [], 0
        if size:
            yield flush(held, counts)

    return run


def _survivors(threshold: int, bits: int):
    def run(group: pa.Table) -> pa.Table:
        mass = sum(group.column("mass").to_pylist())
        parts = (
            (np.frombuffer(k.as_py(), np.uint32), np.frombuffer(zlib.decompress(c.as_py()), np.uint32).astype(np.int64))
            for k, c in zip(group.column("keys"), group.column("counts"), strict=True)
        )
        keys, counts, taken = merge_summaries(parts, mass // threshold + 1)
        keys = keys[counts + taken >= threshold].astype(np.uint64)
        part = group.column("part")[0].as_py()
        whole = (np.uint64(part) << np.uint64(64 - bits) if bits else np.uint64(0)) | keys << np.uint64(32 - bits)
        return pa.table({"key": pa.array(whole.view(np.int64))})

    return run


def partition_bits(mass: int) -> int:
    """Bits that number the hash partitions: about MASS occurrences each."""
    return min(20, max(0, -(-mass // MASS) - 1).bit_length())


def surviving_phrases(docs: DataFrame, k: int, threshold: int, mass: int, words, shorter) -> DataFrame:
    """(key) upper bits of the hashes of all k-word phrases that may occur ``threshold`` times.

    ``mass``: at least the number of phrase occurrences."""
    bits = partition_bits(mass)
    sent = docs.mapInArrow(_summaries(k, bits, words, shorter), "part int, mass long, keys binary, counts binary")
    return sent.groupBy("part").applyInArrow(_survivors(threshold, bits), "key long")


# ── second pass: exact counts ────────────────────────────────────────────────


def _summed(grams: np.ndarray) -> np.ndarray:
    """Rows of (word hashes, count), equal phrases added up."""
    grams = grams[np.lexsort(grams[:, :-1].T[::-1])]
    head = np.flatnonzero(np.concatenate([[True], (grams[1:, :-1] != grams[:-1, :-1]).any(axis=1)]))
    out = grams[head]
    out[:, -1] = np.add.reduceat(grams[:, -1], head)
    return out


def _exact(k: int, bits: int, words, shorter, survivors):
    """Counts of surviving phrases that a task has read: rows of (word hashes, count), packed by hash partition."""

    def flush(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for name, parts in held.items():
            grams = _summed(np.concatenate(parts))
            part = (gram_hashes(grams[:, :-1].reshape(-1), k)[::k] >> np.uint64(63 - bits)).astype(np.int64) >> 1
            order = np.argsort(part, kind="stable")
            grams, part = grams[order], part[order]
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[cuts[:-1]].astype(np.int32)),
                    pa.array([name] * (len(cuts) - 1), pa.string()),
                    pa.array([grams[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ],
                ["part", "lang", "grams"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for t, lang, names in _tokens(batch):
                at, grams = _allowed(t, lang, names, k, words.value, shorter.value if shorter else None)
                hit = _has(survivors.value, grams)
                found, first, n = np.unique(grams[hit], return_index=True, return_counts=True)
                at = at[hit][first]
                for i, name in enumerate(names):
                    own = lang[at] == i
                    if own.any():
                        rows = np.stack([t.hashes[at[own] + j] for j in range(k)] + [n[own].astype(np.uint64)], axis=1)
                        held.setdefault(name, []).append(rows)
                        size += len(rows)
                if size > HELD:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return run


def _frequent(k: int, threshold: int):
    def run(group: pa.Table) -> pa.Table:
        out = []
        langs = group.column("lang").to_pylist()
        for name in sorted(set(langs)):
            rows = [np.frombuffer(g.as_py(), np.uint64).reshape(-1, k + 1) for g, x in zip(group.column("grams"), langs, strict=True) if x == name]
            grams = _summed(np.concatenate(rows))
            grams = grams[grams[:, -1] >= threshold].view(np.int64)
            columns = [pa.array(np.ascontiguousarray(grams[:, i])) for i in range(k + 1)]
            out.append(pa.table([pa.array([name] * len(grams), pa.string()), *columns], ["lang", *[f"w{i + 1}" for i in range(k)], "f"]))
        return pa.concat_tables(out)

    return run


def _counted(docs: DataFrame, k: int, threshold: int, bits: int, words, shorter, survivors) -> DataFrame:
    each = docs.mapInArrow(_exact(k, bits, words, shorter, survivors), "part int, lang string, grams binary")
    schema = "lang string, " + ", ".join(f"w{i + 1} long" for i in range(k)) + ", f long"
    return each.groupBy("part").applyInArrow(_frequent(k, threshold), schema)


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)) in 38-digit decimals."""
    d = "decimal(19, 0)"
    return F.expr(f"({SCALE} * (cast({a} as {d}) * cast({a} as {d}))) div (cast({left} as {d}) * cast({right} as {d}))")


def _salted_column(spark, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows' (lang, hashes) as the salted hash of the phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            parts = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in columns]
            flat = np.stack(parts, axis=1).reshape(-1)
            grams = gram_hashes(flat, len(columns))[:: len(columns)] if len(columns) > 1 else flat
            keys = _salted(grams, langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    return rows.select("lang", *columns).mapInArrow(run, "key long")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split into pieces and words; ``a`` counts a
    phrase within pieces, ``l`` and ``r`` its two parts at the cut of least
    score, ``n`` all words of the language.

    Null text: no words.  Null lang: ``und``, together with texts so marked.
    Repeated rows count as often as they stand there.  Equal scores and counts
    rank by the phrase's bytes.  An empty table gives an empty result.  Other
    columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = materialise(
        texts.mapInArrow(_word_counts, "lang string, w long, word string, f long").groupBy("lang", "w", "word").agg(F.sum("f").alias("f")),
        "words",
    )
    sizes = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = materialise(every.where(F.col("f") >= min_count), "words-frequent")
    mass, rows = (words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count(F.lit(1))).first())  # two numbers
    word_bits = sc.broadcast(_bitmap(_salted_column(spark, words, ["w"]), "key", rows))

    def frequent(k: int, most: int, shorter) -> DataFrame:
        survivors = materialise(surviving_phrases(texts, k, min_count, most, word_bits, shorter), f"survivors-{k}")
        bits = sc.broadcast(_bitmap(survivors, "key", survivors.count()))
        return materialise(_counted(texts, k, min_count, partition_bits(most), word_bits, shorter, bits), f"phrases-{k}")

    pairs = frequent(2, mass, None)
    pair_mass, pair_rows = pairs.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count(F.lit(1))).first()
    pair_bits = sc.broadcast(_bitmap(_salted_column(spark, pairs, ["w1", "w2"]), "key", pair_rows))
    triples = frequent(3, pair_mass, pair_bits)

    def word(i: int) -> DataFrame:
        return words.select("lang", F.col("w").alias(f"w{i}"), F.col("word").alias(f"t{i}"), F.col("f").alias(f"f{i}"))

    pairs = pairs.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"])
    pairs = materialise(pairs.select("lang", "w1", "w2", "f", "f1", "f2", "t1", "t2"), "pairs")
    head = pairs.select("lang", "w1", "w2", F.col("f").alias("f12"), "f1", "t1", "t2")
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"), F.col("f2").alias("f3"), F.col("t2").alias("t3"))
    triples = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    triples = materialise(
        triples.withColumns({"s1": _score("f", "f1", "f23"), "s2": _score("f", "f12", "f3")}).select(
            "lang", "w1", "w2", "w3", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("f").alias("a"),
            F.when(F.col("s2") < F.col("s1"), F.col("f12")).otherwise(F.col("f1")).alias("l"),
            F.when(F.col("s2") < F.col("s1"), F.col("f3")).otherwise(F.col("f23")).alias("r"),
            F.least("s1", "s2").alias("score"),
        ),
        "triples",
    )
    held = triples.select("lang", "w1", "w2", "a").unionByName(
        triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    longest = held.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    alone = pairs.join(longest, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * SHARE))
    pairs = alone.select(
        "lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), _score("f", "f1", "f2").alias("score")
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        pairs.unionByName(triples.select("lang", "phrase", "a", "l", "r", "score"))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)  # cut within each input partition before the exchange
    )
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_PIECES = r"[.,;:!?\x0A-\x0D]"

ORACLE_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PIECES}')) AS piece
    FROM documents
),
spoken AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces
),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g
    FROM spoken, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k
),
counts AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, g, f AS a FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.k, c.g, c.a, cut, x.f AS l, y.f AS r,
           (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.g = c.g[1:cut]
    JOIN counts y ON y.lang = c.lang AND y.g = c.g[cut + 1:]
),
scored AS (SELECT DISTINCT ON (lang, g) * FROM cuts ORDER BY lang, g, score, cut),
inside AS (
    SELECT s.lang, s.g FROM scored s JOIN (SELECT lang, a, unnest([g[1:2], g[2:3]]) AS g FROM candidates WHERE k = 3) t
    ON s.lang = t.lang AND s.g = t.g WHERE 100 * t.a >= 50 * s.a
),
ranked AS (
    SELECT lang, list_aggregate(g, 'string_agg', ' ') AS phrase, a, l, r, cast(score AS BIGINT) AS score
    FROM scored s WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = s.lang AND i.g = s.g)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) JOIN sizes USING (lang)
WHERE rank <= 2000
"""
