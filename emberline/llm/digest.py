"""Improbable-feature digests of documents.

Every window of 64 bytes has an entropy, and the corpus tells how common each entropy level is.
Among any 64 windows in a row the one with the rarest level gets a vote; windows with 16 votes are
the features of a text. They go into a chain of Bloom filters of 160 features each. Two
digests are alike as far as their filters share more bits than chance, as a share of all they could.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.text import _PLACE, mix
from emberline.session import scratch_path

SPAN = 64
VOTES = 16
LEVELS = 1000
#: Windows below this level are near-constant runs and never features.
LOWEST = 100
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
CUTOFF = 0.3
BLOCK_BYTES = 1 << 17

_count = np.arange(SPAN + 1)
_TERM = np.rint(_count * np.log2(np.maximum(_count, 1)) * (1 << 16)).astype(np.int64)
_STEP = np.diff(_TERM).astype(np.int32)


def join_texts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with 63 bytes before each, and where each starts; a last entry is the end."""
    gap = bytes(SPAN - 1)
    starts = np.cumsum([SPAN - 1, *(len(t) + SPAN - 1 for t in texts)])
    return np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8), starts


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy of each window, 0 to LEVELS, from one window to the next by the bytes that enter and leave."""
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, SPAN):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    total = np.empty(len(data) - SPAN + 1, np.int64)
    total[0] = _TERM[np.bincount(data[:SPAN])].sum()
    np.cumsum(_STEP[before[SPAN:]] - _STEP[after[:-SPAN]], out=total[1:], dtype=np.int64)
    total[1:] += total[0]
    return np.rint((1 - total / (SPAN * 6 * 65536.0)) * LEVELS).astype(np.int16)


def _inside(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which windows lie inside one text."""
    change = np.zeros(size + 1, np.int32)
    whole = lengths >= SPAN
    np.add.at(change, starts[:-1][whole], 1)
    np.add.at(change, starts[:-1][whole] + lengths[whole] - SPAN + 1, -1)
    return np.cumsum(change[:-1]).astype(bool)


def _sliding_least(keys: np.ndarray) -> np.ndarray:
    """Least of each SPAN entries in a row: of the end of one block and the start of the next."""
    blocks = -(-len(keys) // SPAN)
    padded = np.full(blocks * SPAN, keys.max(), keys.dtype)
    padded[:len(keys)] = keys
    shaped = padded.reshape(blocks, SPAN)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    last = len(keys) - SPAN + 1
    return np.minimum(behind[:last], ahead[SPAN - 1:SPAN - 1 + last])


def features(texts: Sequence[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Hashes of each text's features, in order, each once.

    A text shorter than a window is one itself, and so is one whose windows are all near-constant runs.
    """
    out: list[np.ndarray] = []
    data, starts = join_texts(texts)
    lengths = np.array([len(t) for t in texts])
    if (lengths >= SPAN).any():
        levels = entropy_levels(data)
        inside = _inside(starts, lengths, len(levels))
        key = np.where(inside & (levels >= LOWEST), ranks[levels].astype(np.int64), LEVELS + 1)
        key = (key << 40) | np.arange(len(key))
        best = _sliding_least(key)
        best = best[best < (LEVELS + 1) << 40] & ((1 << 40) - 1)
        chosen = np.flatnonzero(np.bincount(best, minlength=1) >= VOTES)
        windows = data[chosen[:, None] + np.arange(SPAN)]
        hashed = mix((mix(windows.view(np.uint64)) * _PLACE[:8]).sum(axis=1, dtype=np.uint64))
        cuts = np.searchsorted(chosen, starts)
    else:
        hashed, cuts = np.empty(0, np.uint64), np.zeros(len(texts) + 1, int)
    for i, text in enumerate(texts):
        own = hashed[cuts[i]:cuts[i + 1]]
        if text and not len(own):
            out.append(np.frombuffer(hashlib.blake2b(text, digest_size=8).digest(), np.uint64))
            continue
        out.append(own[np.sort(np.unique(own, return_index=True)[1])])
    return out


def filters(hashes: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, one row of bytes each."""
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), np.uint8)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for i in range(HASHES):
        bits[row, (hashes >> np.uint64(11 * i)).astype(np.int64) % FILTER_BITS] = 1
    return np.packbits(bits, axis=1)


def written(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the best match of each filter of the shorter chain, weighted by its bits."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if (len(a), a.tobytes()) > (len(b), b.tobytes()):
        a, b = b, a
    a64, b64 = a.view(np.uint64), b.view(np.uint64)
    in_a = np.bitwise_count(a64).sum(1, dtype=np.int64)
    in_b = np.bitwise_count(b64).sum(1, dtype=np.int64)
    best = np.zeros(len(a))
    for i in range(len(a)):
        shared = np.bitwise_count(a64[i] & b64).sum(1, dtype=np.int64)
        most = np.minimum(in_a[i], in_b)
        chance = in_a[i] * in_b / FILTER_BITS
        floor = chance + CUTOFF * (most - chance)
        best[i] = max(0.0, float(((shared - floor) / np.maximum(most - floor, 1e-9)).max()))
    return float(min(1.0, (best * in_a).sum() / in_a.sum()))


def _blocks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


# ------------------------------------------------------------------ rarity in the corpus

def rarity(docs: DataFrame) -> np.ndarray:
    """Rank per entropy level, rarest first, from the windows of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            texts = [(t or "") for t in batch.column(0).to_pylist()]
            for first, last in _blocks(texts):
                block = [t.encode() for t in texts[first:last]]
                lengths = np.array([len(t) for t in block])
                if (lengths >= SPAN).any():
                    data, starts = join_texts(block)
                    levels = entropy_levels(data)
                    total += np.bincount(levels[_inside(starts, lengths, len(levels))], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(total)], ["level", "windows"])

    counted = docs.select("text").mapInArrow(run, "level bigint, windows bigint").groupBy("level").agg(
        F.sum("windows").alias("windows"))
    windows = np.zeros(LEVELS + 1, np.int64)
    for row in counted.collect():  # LEVELS + 1 rows
        windows[row.level] = row.windows
    ranks = np.empty(LEVELS + 1, np.int32)
    ranks[np.lexsort((np.arange(LEVELS + 1), windows))] = np.arange(LEVELS + 1)
    return ranks


# ------------------------------------------------------------------ documents and their edits

_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_EDGE = "place int, first_id bigint, first_text string, last_id bigint, last_text string"
_NAMES = [field.split()[0] for field in f"{_RESULT}, {_EDGE}".split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
          pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _results(ids: Sequence, texts: Sequence[str], ranks: np.ndarray) -> Iterator[tuple]:
    """One row per text but the last, which only follows."""
    held = None
    for first, last in _blocks(texts):
        changed = [edited(t, f) for t, f in zip(texts[first:last], texts[first + 1:last + 1])]
        own = [t.encode() for t in texts[first:last]]
        new = [t.encode() for t in changed]
        found = [filters(h) for h in features(own + new, ranks)]
        if held is not None:
            yield (*held, likeness(held_chain, found[0]))
            held = None
        for i in range(len(changed)):
            chain, other = found[i], found[len(own) + i]
            row = (ids[first + i], len(texts[first + i]), hashlib.sha256(new[i]).hexdigest(), written(chain),
                   written(other), likeness(chain, other))
            if i + 1 < len(own):
                yield (*row, likeness(chain, found[i + 1]))
            else:
                held, held_chain = row, chain


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, both fingerprints, and how like the text is to its edit and to the next text.

    The next document has the next smaller doc_id (null last; equal ids by text, greatest first),
    after the last comes the first, so a single one follows itself. The edit puts the start of
    the next text in place of the last half. Null texts are empty; an empty text alone has an empty
    fingerprint, and two of them are alike. Texts are read whole, whatever their length; rows that repeat come out each; an
    empty table gives no rows; other columns take no part, whatever their names.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(rarity(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order; the last one of a task waits, with its first, for the tasks beside it."""
        first, ids, texts = None, [], []
        for batch in batches:
            ids = ids[-1:] + batch.column(0).to_pylist()
            texts = texts[-1:] + [t or "" for t in batch.column(1).to_pylist()]
            if first is None and ids:
                first = (ids[0], texts[0])
            yield _batch([(*row, *[None] * 5) for row in _results(ids, texts, ranks.value)])
        if first is not None:
            yield _batch([(*[None] * 7, TaskContext.get().partitionId(), *first, ids[-1], texts[-1])])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, following in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                out.extend((*row, *[None] * 5) for row in _results([doc, None], [text, following], ranks.value))
            yield _batch(out)

    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()]
    sorted_rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(
        order[0]).sortWithinPartitions(*order)
    path = scratch_path(spark, "digests")
    sorted_rows.mapInArrow(run, f"{_RESULT}, {_EDGE}").write.parquet(path)
    done = spark.read.parquet(path)
    # one row per task of the sort
    by_place = Window.orderBy("place")
    edges = done.filter("place is not null").select(
        F.col("last_id"), "last_text", F.coalesce(
            F.lead("first_text").over(by_place),
            F.first("first_text").over(by_place.rowsBetween(Window.unboundedPreceding, 0))).alias("next"))
    closed = edges.mapInArrow(close, f"{_RESULT}, {_EDGE}")
    return done.filter("place is null").unionByName(closed).select(*_NAMES[:7])
