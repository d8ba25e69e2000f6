"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

Half of the trusted documents train, the others give the thresholds; neither is bounded. The model is a table of counts by hash of
the n-gram, in shards. From the highest order down, blocks of the training text ask the shards how often their n-grams
occur; an n-gram's first asker owns it and adds it to the n-grams one order lower: to the counts of its context, and
as one more predecessor of its suffix. To be scored, blocks of documents ask for the counts of their different n-grams and contexts,
slice by slice, so that only a slice's blocks, questions and answers are on disk at once. Only counts of counts reach the driver.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.components import frees_shuffles, stored
from emberline.llm.katz import Block, _bytes, _numbers, blocks
from emberline.llm.text import different, in_shards, mix
from emberline.operators.order_stats import kth_values
from emberline.session import remove_path, scratch_path

ORDER = 3
QUANTILE = 0.99
#: Steps a span of values is cut into, and values of a group that may be sorted in one place.
STEPS = 1024
DIRECT = 10_000
#: Training tokens of a shard, and a quarter of the tokens scored by one.
SHARD_TOKENS = 500_000
#: Most slices that documents are scored in (each reads them and the model again; fewer put more on disk), and least tokens of one.
SLICES = 10
SLICE_TOKENS = 4_000_000
#: Characters of a word, roughly: only the number of shards follows from it.
_WORD_CHARS = 6
_BLOCK = ("block bigint, doc_ids binary, nulls binary, langs array<string>, held binary, sizes binary, words binary, "
          "tokens binary")
_ENTRY = "order int, shard bigint, block bigint, first binary, second binary, keys binary, sums array<binary>, of array<bigint>"
_SCORE = "doc_id bigint, n_tokens bigint, perplexity double, lang string"


# ------------------------------------------------------------------ blocks

def _named_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts with ids and languages of their rows."""
    langs: list = []

    def noted() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs.extend(batch.column(3).to_pylist())
            yield batch

    for batch in blocks(noted(), lower=False):
        ids = batch.column(1).flatten()
        # blocks hold the rows in order
        own_langs = langs[:len(ids)]
        del langs[:len(ids)]
        columns = [batch.column(0), pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
                   pa.array([ids.is_null().to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                   pa.array([own_langs], pa.list_(pa.string())), *batch.columns[2:]]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _BLOCK.split(", ")])


def _kept_blocks(docs: DataFrame) -> tuple[str, int]:
    """The table of a frame's blocks, bucketed by block, and their tokens."""
    spark, name = docs.sparkSession, f"quality_blocks_{uuid.uuid4().hex}"
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    rows = docs.select("doc_id", "text", F.lit(False).alias("held"), lang).mapInArrow(_named_blocks, _BLOCK)
    rows.write.option("compression", "zstd").bucketBy(_buckets(spark), "block").saveAsTable(name)
    return name, int(spark.table(name).agg(F.sum(F.length("tokens"))).first()[0] or 0) // 4


def _tokens(docs: DataFrame) -> int:
    """About as many as there are."""
    return (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // _WORD_CHARS


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys start; ``keys`` are in order of shard."""
    return np.searchsorted((mix(keys) % np.uint64(shards)).astype(np.int64), np.arange(shards + 1))


def _before(block: Block, tokens: np.ndarray) -> np.ndarray:
    """The tokens before; before a document's first one is an end."""
    return np.where(block.inside[tokens] > 0, tokens - 1, block.ends_at[0])


def _by_token(block: Block, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's different n-grams in order of shard, where each shard's start, and which of them ends at each token (-1: none)."""
    if order == 1:
        at, keys, which = slice(None), block.words, block.word  # found when the block was made
    else:
        at, grams = block.grams(order)
        keys, _, which = different(grams)
    sorted_, cuts = in_shards(keys, block.shards)
    back = np.empty(len(keys), np.int64)
    back[sorted_] = np.arange(len(keys))
    out = np.full(len(block.inside), -1)
    out[at] = back[which]
    return keys[sorted_], cuts, out


def _keys(block: Block, order: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's different n-grams in order of shard, and where each shard's start."""
    keys = block.words
    if order > 1:
        grams = np.sort(block.grams(order)[1])
        keys = grams[np.concatenate([[True], grams[1:] != grams[:-1]])[:len(grams)]]
    sorted_, cuts = in_shards(keys, block.shards)
    return keys[sorted_], cuts


# ------------------------------------------------------------------ the model

def _questions(row, keys: np.ndarray, sums: list[np.ndarray], shards: int) -> pd.DataFrame:
    cuts = _cuts(keys, shards)
    some = np.flatnonzero(np.diff(cuts)).tolist()
    return pd.DataFrame({"shard": some, "block": [row.block] * len(some),
                         "keys": [keys[cuts[k]:cuts[k + 1]].tobytes() for k in some],
                         "sums": [[_bytes(s[cuts[k]:cuts[k + 1]]) for s in sums] for k in some]})


def _merged(order: int):
    """A shard's entries, with its counts of counts, and what its blocks asked for: counts, and which n-grams they own."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        cuts = np.cumsum([len(k) // 8 for k in rows["keys"]])[:-1]
        unique, first, which = different(np.concatenate([np.frombuffer(k, np.uint64) for k in rows["keys"]]))
        sums = [np.bincount(which, np.concatenate([_numbers(s) for s in column]), len(unique)).astype(np.int64)
                for column in zip(*rows["sums"])]
        count, owned = sums[0], np.zeros(len(which), bool)
        owned[first] = True
        of = [len(unique), int(count.sum()), *np.bincount(np.minimum(count, 5), minlength=6)[1:5].tolist()]
        none = [None] * len(rows)
        return pd.DataFrame({
            "order": order, "shard": int(rows["shard"].iloc[0]), "block": [-1, *rows["block"]],
            "first": [None, *[_bytes(c) for c in np.split(count[which], cuts)]],
            "second": [None, *[np.packbits(o).tobytes() for o in np.split(owned, cuts)]],
            "keys": [unique.tobytes(), *none], "sums": [[_bytes(s) for s in sums], *none], "of": [of, *none]})

    return run


def _lower(row, answers: pd.DataFrame, order: int, shards: int) -> pd.DataFrame:
    """What the n-grams that a block owns add to those one order lower."""
    block = Block(row, shards)
    first = block.asked(order)[2]
    answers = answers.sort_values("shard")
    parts = [np.empty(0, np.int64), *[_numbers(v) for v in answers["first"]]]
    owned = np.concatenate([np.empty(0, bool), *[
        np.unpackbits(np.frombuffer(v, np.uint8), count=len(p)).astype(bool) for v, p in zip(answers["second"], parts[1:])]])
    count, own = np.concatenate(parts)[owned], first[owned]
    keys, _, which = _by_token(block, order - 1)
    context = which[_before(block, own)]
    counts = np.bincount(which[own], minlength=len(keys))
    if order > 2:
        # what starts a document has no predecessors to count
        counts += np.bincount(which[block.inside == order - 3], minlength=len(keys))
    sums = [counts, np.bincount(context, count, len(keys)).astype(np.int64)]
    sums += [np.bincount(context[np.minimum(count, 3) == r], minlength=len(keys)) for r in (1, 2, 3)]
    return _questions(row, keys, sums, shards)


def _discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2, and 3 or more lose, from the counts of counts."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [0.0]
    for r in range(1, 4):
        value = r - (r + 1) * y * n[r] / n[r - 1] if n[r - 1] else y
        out.append(value if 0 < value < r else y)
    return np.array(out)


@dataclass
class Model:
    """The table of entries, bucketed by shard; the discounts of each order; and all counts of words."""

    table: str
    shards: int
    discounts: dict[int, np.ndarray]
    total: int


def fit(trusted: DataFrame, asked: int = 0) -> tuple[Model, float]:
    """The model, and the share of a word never seen.

    Every row counts, whole; the model's table stays until ``drop``. Where many more tokens than the training ones will be scored, tell how
    many are ``asked``, roughly: the more shards, the fewer of them come to one.
    """
    spark = trusted.sparkSession
    table, tokens = _kept_blocks(trusted)
    shards = max(1, math.ceil(max(tokens, asked / 4) / SHARD_TOKENS))
    entries, rows = f"quality_model_{uuid.uuid4().hex}", spark.table(table)
    schema, discounts, path = "shard bigint, block bigint, keys binary, sums array<binary>", {}, None

    def highest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                _, keys, _, _, counts = Block(row, shards).asked(ORDER)
                if len(keys):
                    yield _questions(row, keys, [counts], shards)

    def lower(order: int):
        def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            return _lower(next(block.itertuples()), answers, order, shards)

        return run

    for order in range(ORDER, 0, -1):
        if order == ORDER:
            questions = rows.mapInPandas(highest, schema)
        else:
            answers = merged.filter("block >= 0").select("block", "shard", "first", "second")
            questions = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(lower(order + 1), schema)
        # stored first: shuffles of a query that makes a table are not deleted when it ends
        path, last = scratch_path(spark, "merged"), path
        questions.groupBy("shard").applyInPandas(_merged(order), _ENTRY).write.parquet(path)
        if last:
            remove_path(spark, last)
        merged = spark.read.schema(_ENTRY).parquet(path)
        own = merged.filter("block < 0")
        own.select("shard", "order", "keys", "sums").write.mode("append").option("compression", "zstd").bucketBy(
            _buckets(spark), "shard").saveAsTable(entries)
        sizes = [v or 0 for v in own.agg(*[F.sum(F.col("of")[i]) for i in range(6)]).first()]
        discounts[order] = _discounts(sizes[2:])
    remove_path(spark, path)
    spark.sql(f"DROP TABLE {table}")
    words, total, one, two, *_ = sizes
    lost = float(np.dot([one, two, words - one - two], discounts[1][1:]))
    return Model(entries, shards, discounts, total), (lost / total if total else 1.0) / (words + 1)


def drop(spark, model: Model) -> None:
    spark.sql(f"DROP TABLE {model.table}")


# ------------------------------------------------------------------ scores

def _answered(questions: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """Per question and order: which of the n-grams are known, and the counts of these."""
    if not len(questions):
        return pd.DataFrame()
    held = {e.order: (np.frombuffer(e.keys, np.uint64), [_numbers(s) for s in e.sums]) for e in entries.itertuples()}
    answers = []
    for row in questions.itertuples():
        own = []
        for order, asked in enumerate(row.keys, 1):
            asked = np.frombuffer(asked, np.uint64)
            keys, sums = held.get(order, (np.empty(0, np.uint64), []))
            at = np.searchsorted(keys, asked)
            inside = np.flatnonzero(at < len(keys))
            known = np.zeros(len(asked), bool)
            known[inside] = keys[at[inside]] == asked[inside]
            own.append(np.packbits(known).tobytes())
            # the highest order has no contexts
            none = [np.empty(0, np.int64)] * (1 if order == ORDER else 5)
            own += [_bytes(s[at[known]] if len(s) else s) for s in sums or none]
        answers.append(own)
    return pd.DataFrame({"block": questions["block"], "shard": questions["shard"], "answers": answers})


def _chances(block: Block, answers: pd.DataFrame, model: Model, unseen: float) -> np.ndarray:
    """The probability of each token."""
    answers, place = answers.sort_values("shard"), 0
    found, asked = list(answers["answers"]), answers["shard"].to_numpy()
    chance = contexts = None
    for order in range(1, ORDER + 1):
        keys, cuts, which = _by_token(block, order)
        sizes = np.diff(cuts)[asked].tolist()
        known = np.concatenate([np.unpackbits(np.frombuffer(a[place], np.uint8), count=n) for a, n in zip(found, sizes)])
        known, sums = np.flatnonzero(known), []
        for column in range(place + 1, place + (2 if order == ORDER else 6)):
            # the last entry is that of tokens without such an n-gram
            sums.append(np.zeros(len(keys) + 1))
            sums[-1][known] = np.concatenate([_numbers(a[column]) for a in found])
        place += 1 + len(sums)
        discount, count = model.discounts[order], sums[0]
        kept = (count - discount[np.minimum(count, 3).astype(np.int64)])[which]
        if order == 1:
            chance = np.where(count[which] > 0, kept / max(model.total, 1), 0.0) + unseen
        else:
            before = contexts[0][_before(block, np.arange(len(block.inside)))]
            total, *classes = [s[before] for s in contexts[1]]
            lost, some = sum(d * c for d, c in zip(discount[1:], classes)), total > 0
            total = np.where(some, total, 1.0)
            mixed = np.where(count[which] > 0, kept / total, 0.0) + np.where(some, lost / total, 1.0) * chance
            chance = np.where(which >= 0, mixed, chance)
        contexts = which, sums[1:]
    return chance


def perplexity(docs: DataFrame, model: Model, unseen: float, asked: int | None = None) -> DataFrame:
    """doc_id, n_tokens (words and one end), perplexity and lang (null, if ``docs`` has none) per row of ``docs``.

    A null or empty text is its end alone; rows that repeat are scored each; an empty table gives no rows; texts are
    read whole, whatever their length; other columns take no part, whatever their names. ``docs`` is read once per slice,
    so hand in a stored table. Their tokens are counted, unless it is told how many are ``asked``, roughly.
    """
    spark, shards, path = docs.sparkSession, model.shards, scratch_path(docs.sparkSession, "perplexity")
    slices = max(1, min(SLICES, math.ceil((_tokens(docs) if asked is None else asked) / SLICE_TOKENS)))
    entries = spark.table(model.table)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = Block(row, shards)
                keys, cuts = zip(*[_keys(block, order) for order in range(1, ORDER + 1)])
                some = np.flatnonzero(sum(np.diff(c) for c in cuts)).tolist()
                yield pd.DataFrame({"shard": some, "block": [row.block] * len(some), "keys": [
                    [k[c[i]:c[i + 1]].tobytes() for k, c in zip(keys, cuts)] for i in some]})

    def scores(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples())
        block = Block(row, shards)
        logs = np.log(_chances(block, answers, model, unseen))
        total = np.add.reduceat(logs, np.cumsum(block.sizes) - block.sizes)
        ids = pd.arrays.IntegerArray(np.frombuffer(row.doc_ids, np.int64).copy(), np.frombuffer(row.nulls, bool).copy())
        return pd.DataFrame({"doc_id": ids, "n_tokens": block.sizes, "perplexity": np.exp(-total / block.sizes),
                             "lang": list(row.langs)})

    for number in range(slices):
        table, _ = _kept_blocks(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(slices)) == number))
        rows = spark.table(table)
        questions = rows.mapInPandas(ask, "shard bigint, block bigint, keys array<binary>")
        answers = questions.groupBy("shard").cogroup(entries.groupBy("shard")).applyInPandas(
            _answered, "block bigint, shard bigint, answers array<binary>")
        rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scores, _SCORE).write.mode("append").parquet(path)
        spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(_SCORE).parquet(path)


def grouped_quantile(rows: DataFrame, share: float, direct: int = DIRECT) -> DataFrame:
    """group, n and quantile: per group of (group, value) rows the exact quantile, between neighbours linearly.

    As in ``operators.order_stats``, rows are counted per step of the span that holds a wanted rank, and the search goes
    on in that rank's step until it has at most ``direct`` rows or one value; a rank's span is a row here. Null values
    are left out, a null group is one of its own.
    """
    rows = stored(rows.filter("value is not null"), "values")
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    position = F.lit(float(share)) * (F.col("n") - 1)
    ranks = F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank")
    sizes = stored(sizes, "sizes")
    spans = stored(sizes.select("group", ranks, "n", "least", "most").withColumn("target", F.col("rank")), "spans")
    at = F.col("value")
    step = F.when(at == F.col("least"), 0).when(at == F.col("most"), STEPS - 1).otherwise(F.greatest(F.lit(1), F.least(
        F.lit(STEPS - 2), F.floor((at - F.col("least")) / (F.col("most") - F.col("least")) * STEPS))))
    same = F.col("r.group").eqNullSafe(F.col("s.group"))
    inside = at.between(F.col("least"), F.col("most"))
    by_rank = Window.partitionBy("group", "rank").orderBy("step")  # at most STEPS rows
    while True:
        wide = spans.filter((F.col("n") > direct) & (F.col("least") < F.col("most")))
        if not wide.limit(1).count():
            break
        counted = rows.alias("r").join(wide.alias("s"), same & inside).select(
            "s.group", "rank", "target", step.alias("step"), "value").groupBy("group", "rank", "target", "step").agg(
                F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        narrowed = counted.withColumn("before", F.sum("n").over(by_rank) - F.col("n")).filter(
            (F.col("before") <= F.col("target")) & (F.col("target") < F.col("before") + F.col("n"))).withColumn(
                "target", F.col("target") - F.col("before"))
        narrow = spans.filter((F.col("n") <= direct) | (F.col("least") == F.col("most")))
        spans = stored(narrow.unionByName(narrowed.select(*spans.columns)), "spans")
    single = spans.filter("least = most").select("group", "rank", F.col("least").alias("value"))
    sorted_values = rows.alias("r").join(spans.filter("least < most").alias("s"), same & inside).groupBy(
        "s.group", "rank", "target").agg(F.sort_array(F.collect_list("value")).alias("values"))
    found = single.union(sorted_values.select("group", "rank", F.expr("get(values, cast(target as int))")))
    ends = found.groupBy("group").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return stored(sizes.alias("r").join(ends.alias("s"), same).select(
        "r.group", "n", (F.col("low") + (F.col("high") - F.col("low")) * (position - F.floor(position))).alias("quantile")),
        "quantiles")


def _first(ids: DataFrame, wanted: int, count: int) -> DataFrame:
    """The ``wanted`` first of the ``count`` different ids by hash, found by rank, without gathering them."""
    if not wanted:
        return ids.limit(0)
    digest = F.xxhash64("doc_id")
    high = F.shiftright(digest, 12)  # what a double holds exactly
    last = int(kth_values(ids, {"high": high}, {"high": [wanted - 1]}, {"high": count})["high", wanted - 1])
    below = ids.filter(high < last)
    return below.union(ids.filter(high == last).orderBy(digest, "doc_id").limit(wanted - below.count()))


@frees_shuffles
def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, train_docs: int | None = None,
             enough: int | None = None) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold and keep per row of ``docs``.

    Trusted are documents labelled of quality 1 and not toxic. Half of them train, the first by hash of the id (at most
    ``train_docs``, if given). The threshold of a language (null is one too) is the given quantile of all its other
    trusted documents. Where these are fewer than ``enough`` (by default, too few to have a part beyond the quantile: 100 for 0.99), nothing tells what is usual there: the threshold is infinite
    and all of the language is kept. Every row keeps its own language and score, also where a doc_id repeats or is
    null; labels count for every row of their doc_id. Null and empty texts are their end alone, texts are read whole, whatever their length, an
    empty table gives no rows, and other columns take no part, whatever their names.
    """
    ids = stored(labels.filter("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct(),
                 "trusted")
    trusted = ids.count()
    train = trusted // 2 if train_docs is None else min(train_docs, trusted // 2)
    chosen = stored(_first(ids, train, trusted), "split")
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    tokens = _tokens(docs)
    model, unseen = fit(texts, tokens)
    scores = perplexity(docs, model, unseen, tokens)
    drop(docs.sparkSession, model)
    held = scores.join(ids.join(chosen, "doc_id", "left_anti"), "doc_id")
    if enough is None:
        enough = math.ceil(round(1 / (1 - quantile), 6)) if quantile < 1 else 1
    limits = grouped_quantile(held.select(F.col("lang").alias("group"), F.col("perplexity").alias("value")), quantile)
    limits = limits.filter(F.col("n") >= enough).select(F.col("group").alias("lang"), F.col("quantile").alias("threshold"))
    same = F.col("l.lang").eqNullSafe(F.col("t.lang"))
    return scores.alias("l").join(limits.alias("t"), same, "left").select(
        "doc_id", "l.lang", "n_tokens", "perplexity",
        F.coalesce("threshold", F.lit(float("inf"))).alias("threshold")).withColumn(
            "keep", F.col("perplexity") <= F.col("threshold"))
