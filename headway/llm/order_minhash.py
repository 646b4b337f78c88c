"""Near-duplicate classes by Order MinHash and banded alignment.

A text's words (letter case and punctuation aside) give k-mers of two words,
each labelled with its occurrence number in the text.  Each of ``sketches``
hash functions keeps the ``order`` labelled k-mers with the least hashes, in
the order in which the text has them; the tuple is one bucket key.  Such tuples
agree more often the smaller the edit distance is; their number follows from
the share of links at the least similarity that shall meet.  Texts of at most
``short`` words have exact keys besides: of the d + 1 segments of a text at
most d are hit by d edits, and any text within reach has a key for each place
where the one that is left can stand.  Within a bucket every text
is paired with the bucket's least text first.  Texts of different classes that
share a bucket are then all compared where the bucket has few of them, and
joined by their rarest k-mers where it has many: edits within the similarity leave at
least one of these in both texts, whatever order of rarity is used, so no such
pair of a link is missed and no large bucket's texts are all paired.  Pairs are
verified by a banded alignment of whole texts.

Equal texts are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.alignment import edit_similarity
from headway.llm.components import components
from headway.llm.store import free_names, materialise, release
from headway.llm.words import Words, gram_hashes, mix, rows_of, words_of

K = 2
ORDER = 2
SIMILARITY = 0.8
#: Share of the links at just this similarity, edits as far apart as can be, that meet in a bucket.
RECALL = 0.999
#: Texts of at most this many words meet by exact keys too.
SHORT = 24
#: Bags of words that a text's words are counted in, up to 255.
BAGS = 256
#: A centre's text goes out once for as many pairs.
PAIRS_A_COPY = 64
#: Texts of a bucket that are all compared by their bags; those of a larger one are, if they have a rare k-mer in common.
PAIRED = 2048
#: Bits of the counters of how often k-mers occur, by hash.  They only order k-mers by rarity; any order gives the same links.
COUNTER_BITS = 16


def sketches_for(recall: float, similarity: float, order: int, k: int) -> int:
    """Sketches by which a pair of ``similarity`` meets with ``recall`` at least.

    An edit changes at most k of a text's k-mers, so of n words' k-mers about
    n (1 - k (1 - similarity)) are common, and a sketch agrees if the ``order``
    least of all are.
    """
    lost = k * (1.0 - similarity)
    agree = (max(0.0, 1.0 - lost) / (1.0 + lost)) ** order
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - agree))


SKETCHES = sketches_for(RECALL, SIMILARITY, ORDER, K)

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_rng = np.random.default_rng(8)
_ODD = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)


def labelled_kmers(w: Words, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-mer with its occurrence number, in text order.

    A text of fewer than k words, but at least one, has a single shorter k-mer.
    """
    counts = np.diff(w.bounds)
    rows = rows_of(w.bounds)
    grams = gram_hashes(w.hashes, k)
    whole = rows[: len(grams)] == rows[k - 1 :] if len(grams) else np.zeros(0, bool)
    at, grams = rows[: len(grams)][whole], grams[whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array([gram_hashes(w.hashes[w.bounds[r] : w.bounds[r + 1]], int(counts[r]))[0] for r in short], np.uint64)
        at, grams = np.concatenate([at, short]), np.concatenate([grams, extra])
        order = np.argsort(at, kind="stable")
        at, grams = at[order], grams[order]
    own = grams ^ mix(at.astype(np.uint64))
    order = np.argsort(own, kind="stable")
    again = np.zeros(len(own), np.int64)
    if len(own):
        first = np.ones(len(own), bool)
        first[1:] = own[order][1:] != own[order][:-1]
        head = np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
        again[order] = np.arange(len(own)) - head
    return at, mix(grams + mix(again.astype(np.uint64)))


def sketch(w: Words, sketches: int = SKETCHES, k: int = K, found: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Bucket keys (rows x sketches); rows without words have zeros.  ``found``: the labelled k-mers, if they are known."""
    n = len(w.bounds) - 1
    keys = np.zeros((n, sketches), np.uint64)
    at, kmers = labelled_kmers(w, k) if found is None else found
    if not len(kmers):
        return keys
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    full, counts = at[starts], np.diff(np.append(starts, len(at)))
    lone = counts == 1
    # a hash's low bits give way to the place in the text: the least hash says where it is
    low = np.uint64((1 << int(counts.max()).bit_length()) - 1)
    place = (np.arange(len(at)) - np.repeat(starts, counts)).astype(np.uint64)
    for i in range(sketches):
        v = (kmers ^ _SALT[i]) * _ODD[i]
        v ^= v >> np.uint64(32)
        v &= ~low
        v |= place
        one = starts + (np.minimum.reduceat(v, starts) & low).astype(np.int64)
        v[one] = _TOP
        two = np.where(lone, one, starts + (np.minimum.reduceat(v, starts) & low).astype(np.int64) * ~lone)
        first, second = np.minimum(one, two), np.maximum(one, two)
        keys[full, i] = mix(mix(kmers[first] + _SALT[i]) ^ np.where(lone, np.uint64(0), kmers[second]))
    return keys


def edits_allowed(n: int) -> int:
    """Edits within the similarity if the longer text has ``n`` words."""
    return int((1.0 - SIMILARITY) * n + 1e-9)


@cache
def short_places(m: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(segment's words, places in the text, salts) of the exact keys of a text of ``m`` words.

    A text of n >= m words is cut into edits + 1 segments.  One that no edit
    hits stands in the shorter text moved by as many words as the edits before
    it add; those and the edits after it are within the edits allowed.
    """
    found: dict[int, set[tuple[int, int]]] = {}
    for n in range(m, SHORT + 1):
        d = edits_allowed(n)
        if n - m > d:
            continue
        cuts = [n * i // (d + 1) for i in range(d + 2)]
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            for move in range(-d, d + 1):
                if abs(move) + abs(m - n - move) <= d and 0 <= lo + move and hi + move <= m:
                    found.setdefault(hi - lo, set()).add((lo + move, n * (SHORT + 1) + i))
    out = []
    for size, places in sorted(found.items()):
        at, salt = np.array(sorted(places), np.int64).T
        out.append((size, at, mix(salt.astype(np.uint64) + np.uint64(1))))
    return out


def bucket_keys(w: Words, found: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, keys) of each row's buckets: its sketches, and the exact keys of a short text; none without words."""
    counts = np.diff(w.bounds)
    few = [m for m in range(1, SHORT + 1) if np.any(counts == m)]
    exact = np.zeros(SHORT + 1, np.int64)
    for m in few:
        exact[m] = sum(len(at) for _, at, _ in short_places(m))
    size = np.where(counts > 0, SKETCHES, 0) + np.where(counts <= SHORT, exact[np.minimum(counts, SHORT)], 0)
    bounds = np.concatenate([[0], np.cumsum(size)])
    keys = np.zeros(bounds[-1], np.uint64)
    has = np.flatnonzero(counts > 0)
    keys[bounds[has][:, None] + np.arange(SKETCHES)] = sketch(w, found=found)[has]
    grams: dict[int, np.ndarray] = {}
    for m in few:
        rows = np.flatnonzero(counts == m)
        to = bounds[rows] + SKETCHES
        for words, at, salt in short_places(m):
            if words not in grams:
                grams[words] = gram_hashes(w.hashes, words)
            keys[to[:, None] + np.arange(len(at))] = mix(grams[words][w.bounds[rows][:, None] + at] ^ salt)
            to = to + len(at)
    return bounds, keys


def bags_of(w: Words) -> np.ndarray:
    """Words in each bag (rows x BAGS), 255 standing for that many or more."""
    n = len(w.bounds) - 1
    slots = rows_of(w.bounds) * BAGS + (w.hashes >> np.uint64(56)).astype(np.int64)
    return np.minimum(np.bincount(slots, minlength=n * BAGS), 255).astype(np.uint8).reshape(n, BAGS)


def _few_edits(a: np.ndarray, b: np.ndarray, words_a: np.ndarray, words_b: np.ndarray) -> np.ndarray:
    """Whether bags and word counts of the pairs' texts leave the similarity possible."""
    out = np.empty(len(a), bool)
    for i in range(0, len(a), 1 << 14):
        x, y = a[i : i + (1 << 14)], b[i : i + (1 << 14)]
        common = np.minimum(x, y)
        longer = np.maximum(words_a[i : i + (1 << 14)], words_b[i : i + (1 << 14)])
        least = longer - common.sum(axis=1, dtype=np.int64)
        out[i : i + (1 << 14)] = (least <= (1.0 - SIMILARITY) * longer + 1e-9) | (common == 255).any(axis=1)
    return out


def _bag_array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BAGS)


def _slots(kmers: np.ndarray) -> np.ndarray:
    return (kmers >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of each text and, in one more row a task, how often k-mers of each counter occur."""
    names = ["doc_id", "text_key", "n_words", "keys", "bags", "counts"]
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in batches:
        for w in words_of(batch.column("text"), bare=True):
            n = w.last - w.first
            count = np.diff(w.bounds)
            part = batch.slice(w.first, n)
            found = labelled_kmers(w)
            bounds, keys = bucket_keys(w, found)
            counts += np.bincount(_slots(found[1]), minlength=len(counts))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(count, pa.int32()), lists, pa.array(list(map(bytes, bags_of(w))), pa.binary()), pa.nulls(n, pa.binary())],
                names,
            )
    types = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types), pa.array([counts.tobytes()], pa.binary())], names)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in batches:
        for task in batch.column("counts"):
            counts += np.frombuffer(task.as_buffer(), np.int64)
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(counts[slots], pa.int64())], ["slot", "n"])


def rarest_kmers(w: Words, commonness: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the labelled k-mers of each text of which one at least is left by edits within the similarity.

    A text of m words loses at most k (1 - similarity) m of its k-mers on the
    way to any text of a link, and the rarest of those that both have is among
    as many, and one, of the rarest of each.
    """
    at, kmers = labelled_kmers(w)
    order = np.lexsort((kmers, commonness[_slots(kmers)], at))
    at, kmers = at[order], kmers[order]
    lost = np.floor(K * (1.0 - SIMILARITY) * np.diff(w.bounds) + 1e-9).astype(np.int64)
    kept = np.arange(len(at)) - np.searchsorted(at, at) <= lost[at]
    return at[kept], kmers[kept]


def _picking(commonness: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words_of(batch.column("text"), bare=True):
                n = w.last - w.first
                part = batch.slice(w.first, n)
                at, kmers = rarest_kmers(w, commonness)
                bounds = np.searchsorted(at, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(kmers.view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "rare"])

    return run


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, found = [], []
        us, before, a = batch.column("u").to_pylist(), None, None
        for w in words_of(batch.column("text_b"), bare=True):
            for i in range(w.first, w.last):
                if us[i] != before:  # rows of one centre follow each other
                    (words,) = words_of(batch.column("text_a").slice(i, 1), bare=True)
                    before, a = us[i], words.hashes
                alike = edit_similarity(a, w.hashes[w.bounds[i - w.first] : w.bounds[i - w.first + 1]], SIMILARITY)
                if alike is not None:
                    keep.append(i)
                    found.append(alike)
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v"), pa.array(found, pa.float64())], ["u", "v", "similarity"])


def text_node(text: str = "text") -> F.Column:
    """Identity of a text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _near(a: str, b: str) -> F.Column:
    """Whether texts of ``a`` and ``b`` words can be as similar as a link asks."""
    return F.least(a, b) >= F.greatest(a, b) * SIMILARITY - 1e-9


def candidate_pairs(nodes: DataFrame) -> DataFrame:
    """(u, v, near, more) with u the least node of a bucket that holds v too; nodes: node, n_words, keys.

    Not ``near``: lengths alone rule out the similarity.  ``more``: one such
    bucket holds other texts than the two, so v has pairs that u is not in.
    """
    rows = nodes.select("node", "n_words", F.explode("keys").alias("key"))
    centres = (
        rows.groupBy("key")
        .agg(F.min(F.struct("node", "n_words")).alias("c"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", F.col("c.node").alias("u"), F.col("c.n_words").alias("u_words"), (F.col("n") > 2).alias("more"))
    )
    pairs = rows.join(centres, "key").where(F.col("u") != F.col("node"))
    found = pairs.select("u", F.col("node").alias("v"), _near("u_words", "n_words").alias("near"), "more")
    return found.groupBy("u", "v").agg(F.max("near").alias("near"), F.max("more").alias("more"))


def rare_rows(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(node, rare) with the hashes of each text's rarest k-mers; texts: node, text; counts: counts of tasks."""
    sums = counts.mapInArrow(_count_batches, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    commonness = np.zeros(1 << COUNTER_BITS, np.uint8)
    for slot, level in sums.select("slot", F.floor(F.log2("n") * 4).cast("int")).collect():  # a row a counter
        commonness[slot] = level
    return texts.select("node", "text").mapInArrow(_picking(commonness), "node long, rare array<long>")


def _classed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the class of their node: its root, or itself."""
    return rows.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")


def mixed_buckets(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, n_words, n) of the buckets with ``n`` texts of different classes; nodes: node, n_words, keys."""
    rows = _classed(nodes.select("node", "n_words", "keys"), roots).select("node", "n_words", "class", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    return rows.drop("class").join(sizes.where("low <> high").select("key", "n"), "key")


def _pairing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The possible pairs of each bucket; rows of one bucket follow each other."""

    def pairs(rows: pa.RecordBatch, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        node, words, kind = (rows.column(c).to_numpy() for c in ("node", "n_words", "class"))
        bags = _bag_array(rows.column("bags"))
        us, vs = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            least, most = words[lo:hi], words[lo:hi, None]
            unlike = (kind[lo:hi] != kind[lo:hi, None]) & (np.minimum(least, most) >= np.maximum(least, most) * SIMILARITY - 1e-9)
            u, v = np.nonzero(np.triu(unlike, 1))
            for i in range(0, len(u), 1 << 14):
                x, y = u[i : i + (1 << 14)] + lo, v[i : i + (1 << 14)] + lo
                few = _few_edits(bags[x], bags[y], words[x], words[y])
                us.append(np.minimum(node[x[few]], node[y[few]]))
                vs.append(np.maximum(node[x[few]], node[y[few]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (us, vs)], ["u", "v"])

    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column("key").to_numpy()
        starts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        yield from pairs(batch, starts)
        held = batch.slice(starts[-1])  # the last bucket may go on
    if held is not None:
        yield from pairs(held, [0, held.num_rows])


def bucket_pairs(buckets: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(u, v) of texts of different classes of a bucket of at most ``PAIRED`` texts, if their bags leave the similarity possible.

    No pair is a row before that: a bucket's texts are compared where they lie."""
    few = _classed(buckets.where(F.col("n") <= PAIRED).drop("n"), roots)
    rows = few.join(nodes.select("node", "bags"), "node").select("key", "node", "n_words", "class", "bags")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_pairing, "u long, v long").distinct()


def mixed_groups(buckets: DataFrame, rare: DataFrame, roots: DataFrame) -> DataFrame:
    """(group, node, n_words, class, minor) of the texts of a bucket of more than ``PAIRED`` that have a certain
    rare k-mer, of different classes in each group; ``minor``: not of its largest class; rare: node, rare."""
    many = _classed(buckets.where(F.col("n") > PAIRED).drop("n"), roots).join(rare, "node")
    rows = many.select("key", "node", "n_words", "class", F.explode("rare").alias("kmer"))
    rows = rows.select(F.xxhash64("key", "kmer").alias("group"), "node", "n_words", "class")
    own = Window.partitionBy("group")
    sized = rows.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("group", "class")))
    ends = sized.withColumns({"low": F.min("class").over(own), "high": F.max("class").over(own), "main": F.max(F.struct("size", "class")).over(own)})
    return ends.where("low <> high").select("group", "node", "n_words", "class", (F.col("class") != F.col("main.class")).alias("minor"))


def _pairs_with(mixed: DataFrame, others: DataFrame) -> DataFrame:
    """(u, v) of texts of different classes of a group and word counts that leave the similarity possible."""
    its = others.select("group", F.col("node").alias("other"), F.col("n_words").alias("words"), F.col("class").alias("its"), F.col("minor").alias("so"))
    unlike = (F.col("class") != F.col("its")) & _near("n_words", "words")
    once = ~(F.col("minor") & F.col("so")) | (F.col("node") < F.col("other"))
    return mixed.join(its, "group").where(unlike & once).select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct()


def centre_pairs(mixed: DataFrame) -> DataFrame:
    """(u, v) of one text drawn by hash for each group and its texts of other classes."""
    drawn = F.min_by(F.struct("node", "n_words", "class"), F.xxhash64("group", "node")).alias("c")
    return _pairs_with(mixed, mixed.groupBy("group").agg(drawn).select("group", "c.*", F.lit(False).alias("minor")))


def other_pairs(mixed: DataFrame) -> DataFrame:
    """(u, v) of all texts of different classes of a group: one of them at least is not of its largest class."""
    return _pairs_with(mixed.where("minor"), mixed)


def _possible_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [batch.column(f"n_words_{x}").to_numpy() for x in "uv"]
        few = _few_edits(*(_bag_array(batch.column(f"bags_{x}")) for x in "uv"), *words)
        yield batch.select(["u", "v"]).filter(pa.array(few))


def possible_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose bags of words leave the similarity possible; nodes: node, n_words, bags."""
    names = ["n_words", "bags"]
    of = [nodes.select(F.col("node").alias(x), *(F.col(n).alias(f"{n}_{x}") for n in names)) for x in "uv"]
    met = pairs.join(of[0], "u").join(of[1], "v")
    return met.select("u", "v", *(f"{n}_{x}" for n in names for x in "uv")).mapInArrow(_possible_batches, "u long, v long")


def merged_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after ``links`` (u, v) join classes of ``roots`` (node, root)."""
    ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    known = roots.unionByName(ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
    of = [known.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "uv"]
    edges = links.select("u", "v").join(of[0], "u").join(of[1], "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
    moved = components(edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return known.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


def verified_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose whole texts align; texts: node, text (one row a node).

    A centre of many pairs gets one copy of its text for each 64 pairs, so a
    hot centre spreads over tasks.
    """
    sizes = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_COPY).cast("int").alias("copies"))
    salted = pairs.join(sizes, "u").withColumn("salt", F.pmod(F.hash("v"), F.col("copies"))).drop("copies")
    a = sizes.select("u", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    a = a.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_a")), "u")
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("text_b"))
    return (
        salted.join(b, "v")
        .join(a, ["u", "salt"])
        .select("u", "v", "text_a", "text_b")
        .mapInArrow(_verify_batches, "u long, v long, similarity double")
    )


def near_duplicate_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes) of the documents' near-duplicate classes.

    rows: doc_id, text_key (the text's identity), root, for every row of ``docs``.
    classes: root, class_id (least doc_id), keep_node (the text of the least
    doc_id), class_rows, class_texts.

    Two texts are linked if 1 - word edit distance / words of the longer is at
    least 0.8, ignoring letter case and punctuation.  Texts without words are
    linked to equal texts only; null counts as empty.  Null doc_id sorts after
    all others.  Repeated rows fall in one class.  Empty table: empty result.
    """
    plain = docs.select("doc_id", text_node().alias("text_key"), "text")
    written = materialise(plain.mapInArrow(_sketch_batches, "doc_id long, text_key binary, n_words int, keys array<long>, bags binary, counts binary"), "omh-sketch")
    sketched = written.where("counts is null")
    last = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
    distinct = sketched.groupBy("text_key").agg(
        F.min(last).alias("least"), F.count(F.lit(1)).alias("n"), *(F.first(x).alias(x) for x in ("n_words", "keys", "bags"))
    )
    # a short number for each text; the written table fixes it
    nodes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "omh-nodes")
    pairs = materialise(candidate_pairs(nodes), "omh-pairs")
    touched = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = nodes.select("node", F.col("text_key").alias("key"), F.col("least.doc_id").alias("least_id")).join(touched, "node")
    texts = materialise(
        plain.join(wanted, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("least_id")))
        .select("node", "text")
        .dropDuplicates(["node"]),
        "omh-texts",
    )
    tried = materialise(possible_pairs(pairs.where("near").select("u", "v"), nodes), "omh-pairs")
    linked = materialise(verified_pairs(tried, texts), "omh-links")
    roots = materialise(components(linked.select("u", "v")), "omh-roots")
    open_nodes = pairs.where("more").select(F.col("v").alias("node")).distinct()
    buckets = materialise(mixed_buckets(nodes.join(open_nodes, "node", "left_semi"), roots), "omh-buckets")
    large = buckets.where(F.col("n") > PAIRED).select("node").distinct()
    rare = materialise(rare_rows(texts.join(large, "node", "left_semi"), written.where("counts is not null").select("counts")), "omh-rare")
    for others in (centre_pairs, other_pairs):
        mixed = materialise(mixed_groups(buckets, rare, roots), "omh-mixed")
        found = possible_pairs(others(mixed).join(tried, ["u", "v"], "left_anti"), nodes)
        if others is centre_pairs:
            found = found.unionByName(bucket_pairs(buckets, nodes, roots).join(tried, ["u", "v"], "left_anti")).distinct()
        more = materialise(found, "omh-pairs")
        release(mixed)
        linked = materialise(verified_pairs(more, texts), "omh-links")
        tried = tried.unionByName(more)
        if not linked.isEmpty():
            roots = materialise(merged_roots(roots, linked), "omh-roots")
    placed = materialise(
        nodes.select("node", "text_key", "least", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "omh-roots"
    )
    release(buckets, rare, texts, pairs, linked, nodes)
    classes = placed.groupBy("root").agg(
        F.min("least").getField("doc_id").alias("class_id"),
        F.min(F.struct("least", "text_key")).getField("text_key").alias("keep_node"),
        F.sum("n").alias("class_rows"),
        F.count(F.lit(1)).alias("class_texts"),
    )
    rows = sketched.select("doc_id", "text_key").join(placed.select("text_key", "root"), "text_key")
    return rows, classes


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least doc_id of its class), class_rows, class_texts."""
    rows, classes = near_duplicate_classes(docs)
    return rows.join(classes, "root").select("doc_id", "class_id", "class_rows", "class_texts")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one of least doc_id, any one of equal rows."""
    _, classes = near_duplicate_classes(docs)
    key, keep_key, keep_id = free_names(docs, "text_key", "keep_key", "keep_id")
    keep = classes.select(F.col("keep_node").alias(keep_key), F.col("class_id").alias(keep_id))
    own = docs.withColumn(key, text_node())
    return (
        own.join(keep, (F.col(key) == F.col(keep_key)) & F.col("doc_id").eqNullSafe(F.col(keep_id)))
        .dropDuplicates([keep_key, keep_id])
        .select(*docs.columns)
    )
