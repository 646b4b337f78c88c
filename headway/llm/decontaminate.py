"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every word pair of a test item is a seed (letter case and punctuation aside),
of an item of at most five words every word.  A document's n-grams are looked
up among the seeds; a document with as many of an item's seeds as any alignment
of the least score has is aligned with the whole item.  The score is the
alignment's share of a perfect copy's.  An item of fewer than four words is
evidence only if its words together are rare, or if it is the whole document.

Items are handled in blocks of a bounded number of words.  A block's seeds and
words go to every task (a join with a side of known size); documents are never
shuffled, so a passage that a third of them shares makes no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.alignment import least_distance, local_alignment
from headway.llm.words import gram_hashes, rows_of, words_of

#: Items of at most this many words have single words as seeds.
FEW = 5
#: Items of fewer words count only if the product of their words' shares of the corpus is at most RARE, or alone.
EVIDENCE = 4
RARE = 1e-9
SCORE = 0.6
MATCH = 2
#: Words of items that one pass over the documents looks for.
BLOCK_WORDS = 1_000_000


@dataclass
class Block:
    """Seeds of some items: ``seeds`` sorted; seed i belongs to the places
    ``places[bounds[i]:bounds[i+1]]`` = (item, offset in it).  ``alone``: items
    whose copy counts only if it is the whole document."""

    pieces: list[np.ndarray]
    ids: np.ndarray
    seeds: np.ndarray
    bounds: np.ndarray
    places: np.ndarray
    sieve: np.ndarray
    alone: np.ndarray


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        out: list[tuple] = []
        for w in words_of(batch.column("text"), bare=True):
            for r in range(w.last - w.first):
                own = w.hashes[w.bounds[r] : w.bounds[r + 1]]
                if len(own):
                    key = int(gram_hashes(own, len(own)).view(np.int64)[0])
                    out.append((ids[w.first + r], key, len(own), own.tobytes()))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("item_id", "key", "n_words", "words"), x, strict=True)) for x in out],
            schema=pa.schema([("item_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int32()), ("words", pa.binary())]),
        )


def item_words(items: DataFrame) -> DataFrame:
    """item_id, key (of the word sequence), n_words, words of every item; items without words have no row."""
    return items.select("item_id", "text").mapInArrow(
        _item_rows, "item_id long, key long, n_words int, words binary"
    )


def seed_size(n: int) -> int:
    """Words in a seed of an item of ``n`` words."""
    return 1 if n <= FEW else 2


def seeds_needed(n: np.ndarray, least: float = SCORE) -> np.ndarray:
    """Seeds that an alignment of score ``least`` keeps of items of ``n`` words.

    Of m matches in a row cut by e edits, m - e - 1 word pairs stay; the score
    (2 m - e) / 2 n allows e <= 2 m - 2 least n edits, and m is at most n.
    """
    words = np.ceil(least * n - 1e-9)
    pairs = np.ceil((2 * least - 1) * n - 1 - 1e-9)
    return np.maximum(1, np.where(n <= FEW, words, pairs)).astype(np.int64)


def _word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Occurrences in the documents of each word of ``vocabulary`` (sorted), and of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for w in words_of(batch.column("text"), bare=True):
                at = np.minimum(np.searchsorted(vocabulary, w.hashes), len(vocabulary) - 1)
                found = at[vocabulary[at] == w.hashes]
                counts[:-1] += np.bincount(found, minlength=len(vocabulary))
                counts[-1] += len(w.hashes)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "n"])

    sums = docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(vocabulary) + 1, np.int64)
    for slot, n in sums.collect():  # at most one row a word of the block
        counts[slot] = n
    return counts[:-1], int(counts[-1])


def build_block(docs: DataFrame, rows: list, rare: float = RARE) -> Block | None:
    """Seeds of the items in ``rows`` (key, words), judged by all words of ``docs``."""
    if not rows:
        return None
    pieces = [np.frombuffer(r["words"], np.uint64) for r in rows]
    ids = np.array([r["key"] for r in rows], np.int64)
    alone = np.zeros(len(pieces), bool)
    short = [k for k, piece in enumerate(pieces) if len(piece) < EVIDENCE]
    if short:
        vocabulary = np.unique(np.concatenate([pieces[k] for k in short]))
        counts, total = _word_counts(docs, vocabulary)
        share = np.log10((counts + 1) / (total + 1))
        for k in short:
            alone[k] = share[np.searchsorted(vocabulary, pieces[k])].sum() > np.log10(rare)
    seeds, places = [], []
    for k, piece in enumerate(pieces):
        grams = gram_hashes(piece, seed_size(len(piece)))
        seeds.append(grams)
        places.append(np.stack([np.full(len(grams), k), np.arange(len(grams))], 1))
    flat, where = np.concatenate(seeds), np.concatenate(places)
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    sieve = np.zeros(1 << 22, bool)
    sieve[(unique >> np.uint64(42)).astype(np.int64)] = True
    return Block(pieces, ids, unique, np.append(first, len(flat)), where[order], sieve, alone)


def _hits(w, block: Block) -> np.ndarray:
    """(row, item, start of the item on the row) of the seeds found, sorted, where there are enough."""
    rows = rows_of(w.bounds)
    found = []
    needed = seeds_needed(np.array([len(p) for p in block.pieces]))
    for size in {seed_size(len(p)) for p in block.pieces}:
        grams = gram_hashes(w.hashes, size)
        at = np.flatnonzero(block.sieve[(grams >> np.uint64(42)).astype(np.int64)])
        at = at[rows[at] == rows[at + size - 1]]
        slot = np.minimum(np.searchsorted(block.seeds, grams[at]), len(block.seeds) - 1)
        hit = block.seeds[slot] == grams[at]
        at, slot = at[hit], slot[hit]
        many = block.bounds[slot + 1] - block.bounds[slot]
        index = np.repeat(block.bounds[slot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        place = block.places[index]
        where = np.repeat(at, many)
        row = rows[where]
        # different seeds of an item on a row
        pair = row * len(block.pieces) + place[:, 0]
        order = np.lexsort((place[:, 1], pair))
        pair, offset = pair[order], place[order, 1]
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        heads = np.flatnonzero(new)
        fresh = new.copy()
        fresh[1:] |= offset[1:] != offset[:-1]
        if not len(heads):
            continue
        enough = np.add.reduceat(fresh.astype(np.int64), heads) >= needed[pair[heads] % len(block.pieces)]
        kept = order[np.repeat(enough, np.diff(np.append(heads, len(pair))))]
        found.append(np.stack([row[kept], place[kept, 0], (where - w.bounds[row] - place[:, 1])[kept]], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def aligned(w, block: Block, least: float = SCORE) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, start, end) of each item's best passage in each row, if it scores enough."""
    hits = _hits(w, block)
    if not len(hits):
        return
    cut = np.flatnonzero(np.any(hits[1:, :2] != hits[:-1, :2], axis=1)) + 1
    for group in np.split(hits, cut):
        row, k = int(group[0, 0]), int(group[0, 1])
        piece = block.pieces[k]
        own = w.hashes[w.bounds[row] : w.bounds[row + 1]]
        if block.alone[k] and len(own) != len(piece):
            continue
        size, slack = len(piece), len(piece)  # gaps of 0.8 of the item still leave 0.6
        best = (0.0, 0, 0)
        starts = group[:, 2]
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > slack) + 1):
            whole = [s for s in run if s >= 0 and np.array_equal(own[s : s + size], piece)]
            if whole:
                best = (1.0, int(whole[0]), int(whole[0]) + size)
                break
            lo = max(0, int(run[0]) - slack)
            hi = min(len(own), int(run[-1]) + size + slack)
            longer = max(size, hi - lo)  # at most 2 a common word
            if longer - least_distance(piece, own[lo:hi]) < least * size - 1e-9:
                continue
            score, start, end = local_alignment(piece, own[lo:hi], match=MATCH)
            if score / (MATCH * size) > best[0]:
                best = (score / (MATCH * size), lo + start, lo + end)
        if best[0] >= least:
            yield row, k, *best


def _pair_rows(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (w.first + row, block.ids[k], score, start, end)
                for w in words_of(batch.column("text"), bare=True)
                for row, k, score, start, end in aligned(w, block)
            ]
            at, keys, scores, starts, ends = zip(*found, strict=True) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(keys, pa.int64()), pa.array(scores, pa.float64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                ["doc_id", "key", "score", "start_word", "end_word"],
            )

    return run


def _clean_rows(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for w in words_of(batch.column("text"), bare=True):
                for row, *_ in aligned(w, block):
                    clean[w.first + row] = False
            yield batch.filter(pa.array(clean))

    return run


def _blocks(docs: DataFrame, items: DataFrame, block_words: int) -> Iterator[Block]:
    pieces = item_words(items).select("key", "n_words", "words").dropDuplicates(["key"])
    total = pieces.agg(F.sum("n_words")).first()[0] or 0
    parts = -(-total // block_words)
    for k in range(parts):
        part: Column = F.pmod(F.xxhash64("key"), F.lit(parts)) == k
        block = build_block(docs, pieces.where(part).orderBy("key").collect())  # about block_words words
        if block:
            yield block


def contaminated_pairs(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): documents that hold an item, copied or edited.

    The score (0.6 to 1) is that of the item's best passage; the words from
    start_word to before end_word (words of punctuation alone not counted) are
    that passage.  An item of fewer than four words is reported if its words are
    rare together (``RARE``), or if it is the whole document.

    Null text counts as empty and is never reported; null ids are reported as
    null.  Repeated rows are reported each; equal items each.  Empty tables:
    empty result.  Extra columns are not looked at.
    """
    found = None
    for block in _blocks(docs, items, block_words):
        pairs = docs.select("doc_id", "text").mapInArrow(
            _pair_rows(block), "doc_id long, key long, score double, start_word long, end_word long"
        )
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, start_word long, end_word long")
    names = item_words(items).select("item_id", "key").distinct()
    return found.join(names, "key").select("doc_id", "item_id", "score", "start_word", "end_word")


def drop_contaminated(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they are."""
    kept = docs
    for block in _blocks(docs, items, block_words):
        kept = kept.mapInArrow(_clean_rows(block), docs.schema)
    return kept
