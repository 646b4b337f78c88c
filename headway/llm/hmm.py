"""Hidden Markov language model of word sequences.

Words are emitted through classes: each of the ``TOP`` commonest training
words is a class of its own, the end of a text is one, and all other words
fall into ``HASHED`` classes by their hash.  A hidden state emits a class; a
class gives its word a share by the word's training count.  The state model is
so of bounded size, while the counts within classes cover every training word
and stay in Spark.

Training (Baum-Welch): tasks run scaled forward and backward passes and give
expected counts, which are summed across partitions; the driver renews the
bounded parameters.  Training cuts documents into stretches of ``STRETCH``
words (every word of every training document is in one stretch; stretches
after the first have a start distribution of their own).  Scoring does not cut:
a text's likelihood is the exact forward recursion over all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.store import materialise
from headway.llm.words import END, mix, rows_of, words_of

STATES = 6
TOP = 4096
HASHED = 4096
ROUNDS = 4
STRETCH = 64
#: Texts of more words are scored by products of transfer matrices.
LONG_TEXT = 1024
#: Text bytes of a block of documents.
BLOCK_BYTES = 8 << 20
#: A state's first probability of staying: evidence then adds up along a text.
STAY = 0.98
#: Added to every expected count of a start or transition; emissions get as many tokens, dealt
#: by the classes' shares of all training words.
PRIOR = 0.01
PRIOR_TOKENS = 2_000.0

_BLOCK_TYPE = "block long, doc_ids array<long>, held array<boolean>, lengths binary, words binary, codes binary, trained binary"
_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.binary()),
        ("words", pa.binary()),
        ("codes", pa.binary()),
        ("trained", pa.binary()),
    ]
)


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.int32) if size else np.zeros(0, np.int32)


def _block(number: int, ids: list, held: list[np.ndarray], tokens: list[np.ndarray], lengths: list[np.ndarray]) -> pa.RecordBatch:
    """Documents as codes into the block's own words, commonest word first."""
    size, own = np.concatenate(lengths), np.concatenate(held)
    words, codes, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    words, codes = words[order], place[codes]
    trained = np.bincount(codes[np.repeat(~own, size)], minlength=len(words))
    row = {
        "block": number,
        "doc_ids": ids,
        "held": own.tolist(),
        "lengths": size.astype(np.int32).tobytes(),
        "words": words.tobytes(),
        "codes": _packed(codes),
        "trained": _packed(trained.astype(np.int32)),
    }
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first, made = TaskContext.get().partitionId() << 32, 0
    parts: tuple[list, list, list, list] = ([], [], [], [])
    size = 0
    for batch in batches:
        held = np.array(batch.column("held_out").to_pylist(), bool)
        for w in words_of(batch.column("text"), lower=True):
            parts[0].extend(batch.column("doc_id").slice(w.first, w.last - w.first).to_pylist())
            parts[1].append(held[w.first : w.last])
            parts[2].append(np.insert(w.hashes, w.bounds[1:], END))  # one end after each text
            parts[3].append(np.diff(w.bounds) + 1)
            size += len(w.data)
            if size >= BLOCK_BYTES:
                yield _block(first | made, *parts)
                parts, size, made = ([], [], [], []), 0, made + 1
    if parts[0]:
        yield _block(first | made, *parts)


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            words = np.frombuffer(batch.column("words")[row].as_py(), np.int64)
            trained = _unpacked(batch.column("trained")[row].as_py(), len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(words), batch.column("block")[row].as_py(), np.int64)),
                    pa.array(np.arange(len(words), dtype=np.int32)),
                    pa.array(words),
                    pa.array(trained.astype(np.int64)),
                ],
                ["block", "at", "word", "n"],
            )


@dataclass
class Model:
    """Parameters of bounded size.  ``emit``: class x state; ``mass`` of a class:
    its training words + distinct words + 1, 0 for single-word classes;
    ``share``: the classes' shares of all training words."""

    top: np.ndarray  # sorted hashes of the single-word classes
    begin: np.ndarray
    resume: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    mass: np.ndarray
    share: np.ndarray

    def classes(self, words: np.ndarray) -> np.ndarray:
        """Class of each word: 0 the end, then the single words, then the hashed."""
        out = 1 + len(self.top) + (mix(words) % np.uint64(HASHED)).astype(np.int64)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, words), len(self.top) - 1)
            own = self.top[at] == words
            out[own] = 1 + at[own]
        out[words == END] = 0
        return out

    def word_share(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of each word's share of its class; ``counts``: its training count."""
        mass = self.mass[self.classes(words)]
        return np.where(mass > 0, np.log10((counts + 1.0) / np.maximum(mass, 1.0)), 0.0)


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def first_model(top: np.ndarray, class_counts: np.ndarray, class_words: np.ndarray, states: int = STATES) -> Model:
    """Emissions near the classes' shares, each state tilted at random (fixed seed)."""
    rng = np.random.default_rng(5)
    size = 1 + len(top) + HASHED
    share = _normal(class_counts[:size] + 0.02, 0)
    tilt = rng.uniform(0.5, 1.5, (size, states))
    mass = np.where(np.arange(size) > len(top), class_counts + class_words + 1.0, 0.0)
    return Model(
        top,
        np.full(states, 1.0 / states),
        np.full(states, 1.0 / states),
        _normal(rng.uniform(0.5, 1.5, (states, states)) * (1 - STAY) / states + np.eye(states) * STAY, 1),
        _normal(share[:, None] * tilt, 0),
        mass,
        share,
    )


def _padded(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """steps x stretches of tokens, longest stretch first; cells beyond an end repeat a valid token."""
    steps = int(lengths[0])
    return tokens[np.minimum(starts[None, :] + np.arange(steps)[:, None], len(tokens) - 1)]


def expected_counts(model: Model, classes: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Expected counts of begin, resume, move and emit over whole documents, cut into stretches."""
    starts, sizes, first = [], [], []
    at = 0
    for n in lengths:
        cut = np.arange(0, n, STRETCH)
        starts.append(at + cut)
        sizes.append(np.minimum(STRETCH, n - cut))
        first.append(cut == 0)
        at += n
    starts, sizes, first = np.concatenate(starts), np.concatenate(sizes), np.concatenate(first)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, first = starts[order], sizes[order], first[order]
    k = len(model.begin)
    out = {"begin": np.zeros(k), "resume": np.zeros(k), "move": np.zeros((k, k)), "emit": np.zeros((len(model.emit), k))}
    by_state = np.ascontiguousarray(model.emit.T)
    for lo in range(0, len(starts), 2048):
        own, size = starts[lo : lo + 2048], sizes[lo : lo + 2048]
        lead_first = first[lo : lo + 2048]
        cells = _padded(classes, own, size)
        steps = len(cells)
        active = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]  # stretches longer than t
        forward = np.zeros((k, steps, len(own)))
        backward = np.ones((k, len(own)))
        likely = np.take(by_state, cells, axis=1)
        for t in range(steps):
            n = active[t]
            if t == 0:
                a = np.where(lead_first, model.begin[:, None], model.resume[:, None]) * likely[:, 0]
            else:
                a = (model.move.T @ forward[:, t - 1, :n]) * likely[:, t, :n]
            scale = a.sum(axis=0)
            forward[:, t, :n] = a / scale
            likely[:, t, :n] /= scale
        # forward becomes the states' probabilities, given the whole stretch
        for t in range(steps - 1, -1, -1):
            n = active[t]
            if t:
                later = likely[:, t, :n] * backward[:, :n]
                out["move"] += model.move * (forward[:, t - 1, :n] @ later.T)
            forward[:, t, :n] *= backward[:, :n]
            if t:
                backward[:, :n] = model.move @ later
        out["begin"] += forward[:, 0, lead_first].sum(axis=1)
        out["resume"] += forward[:, 0, ~lead_first].sum(axis=1)
        flat = cells.ravel()
        for state in range(k):  # cells beyond a stretch's end hold zeros
            out["emit"][:, state] += np.bincount(flat, forward[state].ravel(), minlength=len(model.emit))
    return out


def renewed(model: Model, counts: dict[str, np.ndarray]) -> Model:
    return replace(
        model,
        begin=_normal(counts["begin"] + PRIOR, 0),
        resume=_normal(counts["resume"] + PRIOR, 0),
        move=_normal(counts["move"] + PRIOR, 1),
        emit=_normal(counts["emit"] + PRIOR_TOKENS * model.share[:, None], 0),
    )


def _forward(model: Model, lead: np.ndarray, cells: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(final state columns, log10 scales) of stretches sorted by length, longest first; ``lead``: state x stretch."""
    now, log = lead.copy(), np.zeros(len(sizes))
    by_state = np.ascontiguousarray(model.emit.T)
    for t in range(len(cells)):
        n = int(np.searchsorted(-sizes, -t, "left"))
        likely = np.take(by_state, cells[t, :n], axis=1)
        a = (model.move.T @ now[:, :n]) * likely if t else now[:, :n] * likely
        total = a.sum(axis=0)
        now[:, :n] = a / total
        log[:n] += np.log10(total)
    return now, log


def log_likelihood(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each document's class sequence: exact scaled forward recursion.

    A long document is the same recursion with its sums grouped otherwise: the
    products of transfer matrices over its stretches, applied in turn.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out = np.zeros(len(lengths))
    short = np.flatnonzero(lengths <= LONG_TEXT)
    short = short[np.argsort(-lengths[short], kind="stable")]
    for lo in range(0, len(short), 2048):
        own = short[lo : lo + 2048]
        lead = np.tile(model.begin[:, None], (1, len(own)))
        _, out[own] = _forward(model, lead, _padded(classes, starts[own], lengths[own]), lengths[own])
    k = len(model.begin)
    for d in np.flatnonzero(lengths > LONG_TEXT):
        own = classes[starts[d] : starts[d] + lengths[d]]
        width = 256
        now = model.begin * model.emit[own[0]]
        log = np.log10(now.sum())
        now /= now.sum()
        rest = own[1:]
        for lo in range(0, len(rest), width * 4096):
            part = rest[lo : lo + width * 4096]
            cut = np.arange(0, len(part), width)
            size = np.minimum(width, len(part) - cut)
            # one row for each stretch and state before it
            lead = np.tile(model.move.T, (1, len(cut)))
            sizes = np.repeat(size, k)
            ends, logs = _forward(model, lead, _padded(part, np.repeat(cut, k), sizes), sizes)
            for s in range(len(cut)):
                row = slice(s * k, (s + 1) * k)
                top = logs[row].max()
                now = ends[:, row] @ (now * 10.0 ** (logs[row] - top))
                log += top + np.log10(now.sum())
                now /= now.sum()
        out[d] = log
    return out


def _flat(counts: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([counts[x].ravel() for x in ("begin", "resume", "move", "emit")])


def _unflat(x: np.ndarray, k: int) -> dict[str, np.ndarray]:
    return {"begin": x[:k], "resume": x[k : 2 * k], "move": x[2 * k : 2 * k + k * k].reshape(k, k), "emit": x[2 * k + k * k :].reshape(-1, k)}


def _round(blocks: DataFrame, model: Model) -> Model:
    """One Baum-Welch round: expected counts of each task, summed by Spark."""
    k = len(model.begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for row in range(batch.num_rows):
                lengths = np.frombuffer(batch.column("lengths")[row].as_py(), np.int32).astype(np.int64)
                held = np.array(batch.column("held")[row].as_py(), bool)
                if held.all():
                    continue
                words = np.frombuffer(batch.column("words")[row].as_py(), np.uint64)
                codes = _unpacked(batch.column("codes")[row].as_py(), int(lengths.sum()))[np.repeat(~held, lengths)]
                total = total + _flat(expected_counts(model, model.classes(words)[codes], lengths[~held]))
        slots = np.flatnonzero(total) if np.ndim(total) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.int64()), pa.array(total[slots] if np.ndim(total) else [], pa.float64())], ["slot", "n"]
        )

    sums = (
        blocks.select("held", "lengths", "words", "codes")
        .mapInArrow(run, "slot long, n double")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
    )
    flat = np.zeros(2 * k + k * k + len(model.emit) * k)
    for slot, n in sums.collect():  # at most one row a parameter
        flat[slot] = n
    return renewed(model, _unflat(flat, k))


def _aligned_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    counts = pdf.sort_values("at")["n"].to_numpy(np.int64)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [counts.astype(np.int64).tobytes()]})


def hmm_scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens: words, A-Z as a-z, then one end.  Learns from the rows whose
    crc32(doc_id as text) mod 7 is not 2.  base_score: log10 of the add-one
    unigram model; score: log10 of the hidden Markov model's exact likelihood.

    Null text counts as empty (its one token is the end).  Null doc_id: in the
    training set.  Repeated rows: each scored.  Without training rows every
    class is new: the scores are those of the untrained model.  Empty table:
    empty result.  Extra columns are not looked at.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    blocks = materialise(docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(_blocks, _BLOCK_TYPE), "hmm-blocks")
    tokens = blocks.select("block", "words", "trained").mapInArrow(_block_words, "block long, at int, word long, n long")
    seen = materialise(tokens.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "hmm-vocabulary")
    known = seen.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, distinct = int(known[0]), int(known[1])
    end = int(END.astype(np.int64))
    common = seen.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(TOP).select("word").collect()
    top = np.sort(np.array([r[0] for r in common], np.int64).view(np.uint64))
    blank = Model(top, *(np.zeros(0) for _ in range(6)))

    def class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 + len(top) + HASHED
        counts, words = np.zeros(size), np.zeros(size)
        for batch in batches:
            cls = blank.classes(batch.column("word").to_numpy().view(np.uint64))
            counts += np.bincount(cls, batch.column("n").to_numpy(), minlength=size)
            words += np.bincount(cls, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(counts), pa.array(words)], ["class", "n", "words"])

    sums = (
        seen.mapInArrow(class_sums, "class long, n double, words double").groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    )
    class_counts, class_words = np.zeros(1 + len(top) + HASHED), np.zeros(1 + len(top) + HASHED)
    for cls, n, words in sums.collect():  # one row a class
        class_counts[cls], class_words[cls] = n, words
    model = first_model(top, class_counts, class_words, states)
    if train_tokens:
        for _ in range(rounds):
            model = _round(blocks, model)

    counts = (
        tokens.select("block", "at", "word")
        .join(seen, "word", "left")
        .select("block", "at", F.coalesce("n", F.lit(0)).alias("n"))
        .groupBy("block")
        .applyInPandas(_aligned_counts, "block long, counts binary")  # a block's words: bounded by its bytes
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = np.frombuffer(batch.column("words")[row].as_py(), np.uint64)
                lengths = np.frombuffer(batch.column("lengths")[row].as_py(), np.int32).astype(np.int64)
                codes = _unpacked(batch.column("codes")[row].as_py(), int(lengths.sum()))
                own = np.frombuffer(batch.column("counts")[row].as_py(), np.int64)
                n, at = len(lengths), rows_of(np.concatenate([[0], np.cumsum(lengths)]))
                base = np.log10((own + 1.0) / (train_tokens + distinct + 1.0))
                inner = np.bincount(at, model.word_share(words, own)[codes], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                        pa.array(batch.column("held")[row].as_py(), pa.bool_()),
                        pa.array(lengths),
                        pa.array(np.bincount(at, own[codes] > 0, minlength=n).astype(np.int64)),
                        pa.array(np.full(n, train_tokens, np.int64)),
                        pa.array(np.bincount(at, base[codes], minlength=n)),
                        pa.array(log_likelihood(model, model.classes(words)[codes], lengths) + inner),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = T._parse_datatype_string(
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return blocks.drop("trained").join(counts, "block").mapInArrow(score, schema)
