"""Katz backoff language model over the corpus itself.

Documents are kept in blocks of words. For each order every block asks, shard by shard, how often its different
n-grams occur in the training documents; the answers, a table partitioned by order, hold the counts for
the block's own n-grams. Frequencies up to ``LARGE`` are discounted by Good-Turing. What a context's n-grams lose is
shared among the words never seen after it, in proportion to their probability one order lower; for that,
blocks add up per context the discounts and the lower probabilities of the n-grams they own. A
token's probability is then found order by order: discounted count, or backoff weight times the lower one.

Blocks are a table bucketed by block, so that only questions and answers are shuffled.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.components import frees_shuffles
from emberline.llm.text import chunks, different, in_shards, mix, runs
from emberline.session import scratch_path

ORDER = 2
LARGE = 5
BLOCK_TOKENS = 1 << 19
SHARD_KEYS = 1_500_000
END = np.uint64(0x51ED270B7F5A1E37)
BLOCK = ("block bigint, doc_ids array<bigint>, held binary, sizes binary, words binary, tokens binary")
_ANSWER = "block bigint, shard bigint, first binary, second binary, large array<bigint>"


# ------------------------------------------------------------------ blocks

def blocks(batches: Iterator[pa.RecordBatch], lower: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows of (block, documents, which are held out, tokens each, different words, tokens by place of their word)."""
    number = TaskContext.get().partitionId() << 32
    docs, held, sizes, hashes = [], [], [], []

    def block() -> pa.RecordBatch:
        lengths = np.concatenate(sizes)
        words = np.concatenate(hashes)
        tokens = np.full(len(words) + len(lengths), END)
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(len(tokens), bool)
        inside[ends] = False
        tokens[inside] = words
        unique, which = np.unique(tokens, return_inverse=True)
        row = [number, docs, np.array(held, bool).tobytes(), (lengths + 1).astype(np.int64).tobytes(),
               unique.tobytes(), which.astype(np.int32).tobytes()]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                          [f.split()[0] for f in BLOCK.split(", ")])

    for batch in batches:
        for chunk in chunks(batch.column(1)):
            docs += batch.column(0)[chunk.first:chunk.last].to_pylist()
            held += batch.column(2)[chunk.first:chunk.last].to_pylist()
            sizes.append(np.diff(chunk.offsets))
            hashes.append(chunk.hashes(lower))
            if sum(map(len, hashes)) + len(docs) >= BLOCK_TOKENS:
                yield block()
                number += 1
                docs, held, sizes, hashes = [], [], [], []
    if docs:
        yield block()


def _bytes(counts: np.ndarray) -> bytes:
    """Counts in the least size that holds them all, after a byte that tells it."""
    size = int(np.searchsorted([1 << 8, 1 << 16, 1 << 32], counts.max(initial=0), "right"))
    return bytes([size]) + counts.astype((np.uint8, np.uint16, np.uint32, np.int64)[size]).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, (np.uint8, np.uint16, np.uint32, np.int64)[data[0]], offset=1).astype(np.int64)


class Block:
    """A block's tokens with, per order learnt so far, counts and probabilities at every token."""

    def __init__(self, row, shards: int):
        self.block, self.docs, self.shards = row.block, row.doc_ids, shards
        self.sizes = np.frombuffer(row.sizes, np.int64)
        self.held = np.frombuffer(row.held, bool)
        #: Different words, in order, and which of them each token is.
        self.words, self.word = np.frombuffer(row.words, np.uint64), np.frombuffer(row.tokens, np.int32)
        tokens = self.words[self.word]
        self.trains = np.repeat(~self.held, self.sizes)
        # each document after an end, which is the context of its first token
        self.place = np.arange(len(tokens)) + np.repeat(np.arange(len(self.sizes)) + 1, self.sizes)
        self.inside = np.arange(len(tokens)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.sequence = np.full(len(tokens) + len(self.sizes), END)
        self.sequence[self.place] = tokens
        self.ends_at = np.flatnonzero(tokens == END)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that have so much before them, and the hash of the n-gram that ends at each."""
        at = np.flatnonzero(self.inside + 2 >= order)
        if order == 1:
            return at, self.sequence[self.place[at]]
        return at, runs(self.sequence, order)[self.place[at] - order + 1]

    def asked(self, order: int):
        """Different n-grams in order of shard, which of them each token has, and their training counts."""
        at, grams = self.grams(order)
        keys, first, which = different(grams)
        keys, first, which = self._by_shard(keys, first, which)
        return at, keys, at[first], which, np.bincount(which, self.trains[at], len(keys)).astype(np.int64)

    def contexts(self, order: int):
        """Different contexts in order of shard, and which of them each token has."""
        at = np.flatnonzero(self.inside + 2 >= order)
        grams = (self.sequence if order == 2 else runs(self.sequence, order - 1))[self.place[at] - order + 1]
        keys, first, which = different(grams)
        keys, first, which = self._by_shard(keys, first, which)
        return at, keys, at[first], which

    def _by_shard(self, keys, first, which):
        order, _ = in_shards(keys, self.shards)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return keys[order], first[order], back[which]

    def rows(self, keys: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
        """A question per shard; ``keys`` and all columns are in order of shard."""
        cuts = np.searchsorted((mix(keys) % np.uint64(self.shards)).astype(np.int64), np.arange(self.shards + 1))
        some = np.flatnonzero(np.diff(cuts)).tolist()
        return pd.DataFrame({"shard": some, "block": [self.block] * len(some), **{
            name: [_bytes(values[cuts[k]:cuts[k + 1]]) if name == "counts" else values[cuts[k]:cuts[k + 1]].tobytes()
                   for k in some] for name, values in {"keys": keys, **columns}.items()}})

    def learn(self, answers: pd.DataFrame, discounts: dict[int, Discounts], upto: int) -> None:
        """Probabilities of the orders whose answers are there: ``count`` and ``chance`` are those of the last."""
        self.chance = None
        for order in range(1, upto + 1):
            own = answers[answers["kind"] == f"count{order}"].sort_values("shard")
            at, keys, first, which, _ = self.asked(order)
            parts = [_numbers(v) for v in own["first"]]
            count = np.concatenate(parts)
            self.owned = np.concatenate([np.unpackbits(np.frombuffer(v, np.uint8), count=len(p)).astype(bool)
                                         for v, p in zip(own["second"], parts)])
            discount = discounts[order]
            if order == 1:
                self.known = count[which]
                self.chance = np.where(self.known > 0, discount.kept(self.known) / discount.whole, discount.unseen)
                before, self.count = None, self.known
                continue
            before, self.lower = self.count, self.chance
            self.count = np.zeros(len(self.inside), np.int64)
            self.count[at] = count[which]
            own = answers[answers["kind"] == f"context{order}"].sort_values("shard")
            if not len(own):
                return
            _, _, _, context = self.contexts(order)
            lost = np.concatenate([np.frombuffer(v, np.float64) for v in own["first"]])[context]
            seen = np.concatenate([np.frombuffer(v, np.float64) for v in own["second"]])[context]
            total = self.context_count(order, before)[at].astype(float)
            self.chance = self.lower.copy()
            self.chance[at] = backed_off(self.count[at], discount.kept(self.count[at]), total, lost, seen, self.lower[at])

    def context_count(self, order: int, before: np.ndarray) -> np.ndarray:
        """How often each token's context occurs in training: as often as it is followed by anything."""
        out = np.zeros(len(self.inside), np.int64)
        later = np.flatnonzero(self.inside > 0)
        out[later] = before[later - 1]
        if order == 2:
            # a document's start: as many as training documents, which is the count of ends
            out[self.inside == 0] = before[self.ends_at[0]]
        return out


def backed_off(count, kept, total, lost, seen, lower) -> np.ndarray:
    """Probability after a context with ``total`` occurrences whose n-grams lose ``lost`` and whose followers
    have the summed lower probability ``seen``; sums to one over all words."""
    open_ = 1 - seen > 1e-12
    # without any discount one more occurrence makes room for the unseen
    spare = np.where(lost > 0, lost, 1.0)
    whole = np.where(lost > 0, total, total + 1)
    # where every word has been seen, the discounts are given back
    whole = np.where(open_, whole, total - lost)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(total > 0, np.where(open_, spare / whole / (1 - seen), 0.0), 1.0)
        return np.where(count > 0, kept / whole, weight * lower)


# ------------------------------------------------------------------ counts and discounts

class Discounts:
    """Good-Turing ratios for counts up to LARGE from the counts of counts."""

    def __init__(self, of: np.ndarray, total: int):
        """``of[r]`` n-grams occur r times, for r up to LARGE + 1."""
        ratio = np.ones(LARGE + 2)
        gone = (LARGE + 1) * of[LARGE + 1] / of[1] if of[1] else 1.0
        absolute = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.0
        for r in range(1, LARGE + 1):
            good = -1.0
            if of[r] and gone < 1:
                good = ((r + 1) * of[r + 1] / of[r] / r - gone) / (1 - gone)
            # where counts of counts give no ratio between 0 and 1, an absolute discount
            ratio[r] = good if 0 < good < 1 else (r - absolute) / r if absolute < r else 0.5
        self.ratio, self.total = ratio, total
        lost = float(sum((1 - ratio[r]) * r * of[r] for r in range(1, LARGE + 1)))
        self.whole = total if lost > 0 else total + 1
        self.unseen = (lost if lost > 0 else 1.0) / self.whole

    def kept(self, count: np.ndarray) -> np.ndarray:
        return self.ratio[np.minimum(count, LARGE + 1)] * count


def _merge_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """Total of each key; its first asker with a training occurrence owns it. The first row has the shard's sums."""
    rows = rows.sort_values("block")
    sizes = [len(k) // 8 for k in rows["keys"]]
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in rows["keys"]])
    counts = np.concatenate([_numbers(c) for c in rows["counts"]])
    unique, which = np.unique(keys, return_inverse=True)
    total = np.bincount(which, counts, len(unique)).astype(np.int64)
    trained = np.flatnonzero(counts > 0)
    _, first = np.unique(which[trained], return_index=True)
    owned = np.zeros(len(keys), bool)
    owned[trained[first]] = True
    of = np.bincount(np.minimum(total, LARGE + 2), minlength=LARGE + 3)
    sums = [int(total.sum()), int((total > 0).sum()), *of[:LARGE + 2].tolist()]
    cuts = np.cumsum(sizes)[:-1]
    return pd.DataFrame({"block": rows["block"], "shard": rows["shard"],
                         "first": [_bytes(a) for a in np.split(total[which], cuts)],
                         "second": [np.packbits(a).tobytes() for a in np.split(owned, cuts)],
                         "large": [sums] + [None] * (len(rows) - 1)})


def _merge_contexts(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    sizes = [len(k) // 8 for k in rows["keys"]]
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in rows["keys"]])
    unique, which = np.unique(keys, return_inverse=True)
    cuts = np.cumsum(sizes)[:-1]
    out = {}
    for name, of in (("first", "lost"), ("second", "seen")):
        total = np.bincount(which, np.concatenate([np.frombuffer(v, np.float64) for v in rows[of]]), len(unique))
        out[name] = [a.tobytes() for a in np.split(total[which], cuts)]
    return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], **out, "large": [None] * len(rows)})


# ------------------------------------------------------------------ the model

class _Corpus:
    """The blocks, and the answers so far."""

    def __init__(self, docs: DataFrame, held: F.Column):
        self.spark = docs.sparkSession
        self.table, self.path = f"katz_blocks_{uuid.uuid4().hex}", scratch_path(self.spark, "katz")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held")).mapInArrow(blocks, BLOCK)
         .write.bucketBy(buckets, "block").saveAsTable(self.table))
        self.blocks = self.spark.table(self.table)
        tokens = self.blocks.agg(F.sum(F.length("tokens")) / 4).first()[0] or 0
        self.shards = max(1, math.ceil(tokens / SHARD_KEYS))
        self.discounts: dict[int, Discounts] = {}
        self.total = self.different = 0

    def answers(self) -> DataFrame:
        return self.spark.read.schema(f"{_ANSWER}, kind string").parquet(self.path)

    def store(self, kind: str, rows: DataFrame) -> DataFrame:
        rows.withColumn("kind", F.lit(kind)).write.mode("append").partitionBy("kind").parquet(self.path)
        return self.answers().filter(F.col("kind") == kind)

    def each_block(self, function: Callable, schema: str) -> DataFrame:
        """``function(block row, its answers)`` over all blocks."""
        def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            return function(next(block.itertuples()), answers)

        return self.blocks.groupBy("block").cogroup(
            self.answers().drop("large").groupBy("block")).applyInPandas(run, schema)

    def count(self, order: int) -> None:
        """Ask for the counts of all n-grams of an order, and find its discounts."""
        shards, discounts = self.shards, self.discounts
        schema = "shard bigint, block bigint, keys binary, counts binary"

        def ask(row) -> pd.DataFrame:
            block = Block(row, shards)
            _, keys, _, _, counts = block.asked(order)
            return block.rows(keys, counts=counts)

        questions = self.blocks.mapInPandas(
            lambda batches: (ask(row) for batch in batches for row in batch.itertuples()), schema)
        found = self.store(f"count{order}", questions.groupBy("shard").applyInPandas(_merge_counts, _ANSWER))
        sums = found.filter("large is not null").select(*[
            F.sum(F.col("large")[i]).alias(f"s{i}") for i in range(LARGE + 4)]).first()
        total, different, *of = [v or 0 for v in sums]
        discounts[order] = Discounts(np.array(of, float), total)
        if order == 1:
            self.total, self.different = total, different

    def weigh(self, order: int) -> None:
        """Ask for what each context loses, and for the lower probability of what follows it."""
        shards, discounts = self.shards, dict(self.discounts)

        def ask(row, answers: pd.DataFrame) -> pd.DataFrame:
            block = Block(row, shards)
            block.learn(answers, discounts, order)
            at, _, first, _, _ = block.asked(order)
            _, keys, _, context = block.contexts(order)
            by_token = np.full(len(block.inside), -1)
            by_token[at] = context
            own = first[block.owned]
            count = block.count[own]
            lost = np.bincount(by_token[own], count - discounts[order].kept(count), len(keys))
            seen = np.bincount(by_token[own], block.lower[own], len(keys))
            return block.rows(keys, lost=lost, seen=seen)

        questions = self.each_block(ask, "shard bigint, block bigint, keys binary, lost binary, seen binary")
        self.store(f"context{order}", questions.groupBy("shard").applyInPandas(_merge_contexts, _ANSWER))


@frees_shuffles
def score(docs: DataFrame, held: F.Column, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row of ``docs``.

    ``held`` tells which rows do not train (null: they do). Scores are log10 probabilities of the lower-cased words and
    one end; a null or empty text is its end alone. Rows that repeat count, and are scored, each; words never seen
    share one outcome. Without training rows every probability is one; an empty table gives no rows.
    """
    corpus = _Corpus(docs, held)
    corpus.count(1)
    for k in range(2, order + 1):
        corpus.count(k)
        corpus.weigh(k)
    shards, discounts, total, different = corpus.shards, corpus.discounts, corpus.total, corpus.different

    def scores(row, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(row, shards)
        block.learn(answers, discounts, order)
        starts = np.cumsum(block.sizes) - block.sizes
        base = np.log10((block.known + 1) / (total + different + 1))
        return pd.DataFrame({
            "doc_id": pd.array(list(block.docs), "Int64"), "held_out": block.held, "n_tokens": block.sizes,
            "n_known": np.add.reduceat((block.known > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(block.chance), starts)})

    path = scratch_path(corpus.spark, "katz-scores")
    corpus.each_block(scores, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
                      "score double").write.parquet(path)
    corpus.spark.sql(f"DROP TABLE {corpus.table}")
    return corpus.spark.read.parquet(path).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"),
        "base_score", "score")


def one_in_seven(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 7 == 2
