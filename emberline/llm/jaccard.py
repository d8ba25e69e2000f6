"""Documents that share most of their 5-word shingles, by a tree over count vectors.

A document is the set of its shingle hashes. Hashed into groups it becomes a point of counts, and two sets
share no more than the sum of the lesser counts. Two documents link when 9 * shared >= 4 * (a + b)
(a Jaccard similarity of 0.8), so pairs whose minima sum to less are out. The same bound with one group per
hash, taken over the coordinates in a common order, says that linked documents share one of
their first ``n - ceil(0.8 n) + 1``: those coordinates say which points can meet, and so which
trees are built. In a tree (an R-tree of 256 group counts) a box holds the greatest counts below it; pairs of
boxes that cannot reach the bound are cut. What survives is verified on the sets.

Only as many pairs are verified as components need: a pair within one component is left out. Each
round takes the likeliest pairs across components, and more of them each time, until none
is left, so that no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.bitset import bitset, holds
from emberline.llm.components import connected, frees_shuffles, stored
from emberline.llm.text import Chunk, chunks, mix, release_memory, runs

WORDS = 5
GROUPS = 256
#: One counter per hash slot tells common shingles apart; these come last in the common order. Only hashes below
#: a limit are counted: the others come late anyway.
SLOT_BITS = 22
SLOT_ROWS = 64
COUNTED = np.uint64(int(0.35 * 2 ** 64))
COMMON = 16
SHARD_TOKENS = 1_000_000
BLOCK = 4096
LEAF = 16
SLOT_SETS = 200
VERIFY_ROWS = 1000
FAN = 256
#: Points that sets of a slot which overlap by half may have together, so that one tree serves them all.
TOGETHER = 4 * BLOCK

# ------------------------------------------------------------------ shingles


def shingle_sets(chunk: Chunk) -> Iterator[np.ndarray]:
    """Per row the distinct shingle hashes, in order; fewer words than a shingle make one."""
    words = chunk.hashes(lower=True)
    every = runs(words, WORDS)
    for start, end in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist()):
        if end - start >= WORDS:
            yield np.unique(every[start:end - WORDS + 1])
        elif end > start:
            yield runs(words[start:end], end - start) + np.uint64(end - start)
        else:
            yield np.empty(0, np.uint64)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def commonness(docs: DataFrame) -> np.ndarray:
    """Per hash slot, how common its shingles are in all documents: 0, or doublings of the mean from 4 times on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(1 << SLOT_BITS, np.uint32), []

        def add() -> None:
            slots, counts = np.unique(np.concatenate(waiting), return_counts=True)
            total[slots] += counts.astype(np.uint32)
            waiting.clear()

        for batch in batches:
            for chunk in chunks(batch.column(0)):
                tokens = runs(chunk.hashes(lower=True), WORDS)
                waiting.append(_slot(tokens[tokens < COUNTED]))
                if sum(map(len, waiting)) >= 1 << 20:
                    add()
        if waiting:
            add()
        for part, counts in enumerate(np.split(total, SLOT_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([counts.tobytes()], pa.binary())],
                                             ["part", "counts"])

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        counts = sum(np.frombuffer(c, np.uint32).astype(np.int64) for c in rows["counts"])
        return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [np.minimum(counts, 2 ** 32 - 1).astype(
            np.uint32).tobytes()]})

    kind = "part bigint, counts binary"
    parts = docs.select("text").mapInArrow(run, kind).groupBy("part").applyInPandas(add_up, kind).collect()
    # SLOT_ROWS rows of a fixed size
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for row in parts:
        size = len(counts) // SLOT_ROWS
        counts[row.part * size:(row.part + 1) * size] = np.frombuffer(row.counts, np.uint32)
    share = counts / max(1.0, counts.mean())
    return np.where((share >= 4) & (counts >= COMMON), np.log2(np.maximum(share, 1)), 0).astype(np.uint8)


def first_coordinates(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first of a set's coordinates in the common order, one of which a linked set shares."""
    wanted = len(tokens) - (4 * len(tokens) + 4) // 5 + 1
    levels = np.where(tokens < COUNTED, common[_slot(tokens)], 0)
    if not levels.any():
        return tokens[:wanted]
    return tokens[np.argsort(levels, kind="stable")[:wanted]]


def count_vector(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((mix(tokens) >> np.uint64(56)).astype(np.int64), minlength=GROUPS).astype(np.uint16)


def packed(vector: np.ndarray) -> bytes:
    """A byte per count where that is enough."""
    return (vector.astype(np.uint8) if vector.max(initial=0) < 256 else vector).tobytes()


def unpacked(rows: Sequence[bytes]) -> np.ndarray:
    out = np.empty((len(rows), GROUPS), np.uint16)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, np.uint8 if len(row) == GROUPS else np.uint16)
    return out


def _sketches(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ones, twos, sizes, firsts, vectors = [], [], [], [], []
                for tokens in shingle_sets(chunk):
                    ones.append(int(np.bitwise_xor.reduce(tokens, initial=np.uint64(0)).view(np.int64)))
                    twos.append(int(mix(tokens + np.uint64(7)).sum(dtype=np.uint64).view(np.int64)))
                    sizes.append(len(tokens))
                    firsts.append(first_coordinates(tokens, common.value).tobytes() if len(tokens) else b"")
                    vectors.append(packed(count_vector(tokens)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[chunk.first:chunk.last], pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(firsts, pa.binary()), pa.array(vectors, pa.binary())],
                    ["doc_id", "one", "two", "n", "firsts", "vector"])

    return run


# ------------------------------------------------------------------ which points can meet

def _post(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_pylist()
            ids, sizes = (np.array(batch.column(i).to_pylist(), np.int64) for i in range(2))
            tokens = np.frombuffer(b"".join(lists), np.uint64)
            row = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) // 8 for x in lists])
            shard = (mix(tokens) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            out = []
            for k in range(shards):
                own = order[cuts[k]:cuts[k + 1]]
                if len(own):
                    rows, which = np.unique(row[own], return_inverse=True)
                    out.append((k, tokens[own].tobytes(), which.astype(np.int32).tobytes(), ids[rows].tobytes(),
                                sizes[rows].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(
                (pa.int64(), *[pa.binary()] * 4))], ["shard", "tokens", "which", "ids", "sizes"])

    return run


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Points of one shard that share a coordinate and may be alike by size, each set of them once."""
    tokens = np.concatenate([np.frombuffer(t, np.uint64) for t in rows["tokens"]])
    which = [np.frombuffer(w, np.int32) for w in rows["which"]]
    ids = np.concatenate([np.frombuffer(i, np.int64)[w] for i, w in zip(rows["ids"], which)])
    sizes = np.concatenate([np.frombuffer(s, np.int64)[w] for s, w in zip(rows["sizes"], which)])
    order = np.lexsort((ids, sizes, tokens))
    tokens, ids, sizes = tokens[order], ids[order], sizes[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (5 * sizes[:-1] < 4 * sizes[1:])
    starts = np.flatnonzero(new)
    counts = np.diff(starts, append=len(tokens))
    digest = np.add.reduceat(mix(ids.view(np.uint64)), starts) if len(starts) else np.empty(0, np.uint64)
    many = np.flatnonzero(counts > 1)
    _, once = np.unique(np.stack([digest[many], counts[many].astype(np.uint64)]), axis=1, return_index=True)
    out = []
    for k in many[once]:
        members = ids[starts[k]:starts[k] + counts[k]]
        size = sizes[starts[k]:starts[k] + counts[k]]
        blocks = range(0, len(members), BLOCK)
        for i in blocks:
            for j in blocks:
                # blocks follow by size: a later one may be out of reach
                if j == i and (len(members) <= BLOCK or j == blocks[-1]):
                    met = members[i:i + BLOCK]
                elif j > i and 5 * size[min(i + BLOCK, len(size)) - 1] >= 4 * size[j]:
                    met = np.concatenate([members[i:i + BLOCK], members[j:j + BLOCK]])
                else:
                    continue
                met = np.sort(met)
                out.append((int(mix(met.view(np.uint64)).sum(dtype=np.uint64).view(np.int64)), int(met[0]),
                            met.tolist()))
    release_memory()
    return pd.DataFrame(out, columns=["digest", "least", "members"])


# ------------------------------------------------------------------ the tree

class CountTree:
    """An R-tree over count vectors, packed by halving at the median of the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray):
        self.points, self.sizes, self.parts = points, sizes, parts
        spans = [(0, len(sizes))]
        # points of one component side by side, then by size
        order = np.lexsort((sizes, parts))
        self.levels: list[list[tuple[int, int]]] = [spans]
        while any(b - a > LEAF for a, b in spans):
            halves = []
            for a, b in spans:
                if b - a <= LEAF:
                    halves.append((a, b))
                    continue
                own = order[a:b]
                if parts[own[0]] == parts[own[-1]]:
                    values = points[own]
                    wide = int(np.argmax(values.max(0).astype(int) - values.min(0)))
                    order[a:b] = own[np.argsort(values[:, wide], kind="stable")]
                halves += [(a, (a + b) // 2), ((a + b) // 2, b)]
            spans = halves
            self.levels.append(spans)
        self.order, self.leaves = order, spans

    def boxes(self, spans: list[tuple[int, int]]):
        own = [self.order[a:b] for a, b in spans]
        return (np.array([self.points[o].max(0) for o in own]), np.array([self.sizes[o].min() for o in own]),
                np.array([self.sizes[o].max() for o in own]), np.array([self.parts[o].min() for o in own]),
                np.array([self.parts[o].max() for o in own]))

    def meeting_leaves(self, sought: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Pairs of leaves whose boxes can reach the bound, level by level from the root; with ``sought`` those that hold
        one of these points at least."""
        pairs, before = [(0, 0)], self.levels[0]
        for spans in self.levels[1:] or [self.levels[0]]:
            if not pairs:
                break
            below = {span: [i for i, s in enumerate(spans) if span[0] <= s[0] and s[1] <= span[1]] for span in before}
            most, least_size, most_size, least_part, most_part = self.boxes(spans)
            next_pairs = sorted({(min(i, j), max(i, j)) for p, q in pairs for i in below[before[p]]
                                 for j in below[before[q]]})
            a, b = np.array(next_pairs).T
            keep = (5 * most_size[a] >= 4 * least_size[b]) & (5 * most_size[b] >= 4 * least_size[a])
            keep &= ~((least_part[a] == most_part[a]) & (least_part[b] == most_part[b]) & (least_part[a] == least_part[b]))
            if sought is not None:
                any_sought = np.array([sought[self.order[x:y]].any() for x, y in spans])
                keep &= any_sought[a] | any_sought[b]
                a, b, next_pairs, keep = a[keep], b[keep], [next_pairs[i] for i in np.flatnonzero(keep)], keep[keep]
            for block in np.array_split(np.arange(len(a)), len(a) // 4096 + 1):
                shared = np.minimum(most[a[block]], most[b[block]]).sum(1, dtype=np.int64)
                keep[block] &= 9 * shared >= 4 * (least_size[a[block]] + least_size[b[block]])
            pairs, before = [next_pairs[i] for i in np.flatnonzero(keep)], spans
        return pairs

    def candidates(self, spanning: bool, sought: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points of different components that the bound lets pass, in blocks.

        ``spanning`` only looks within leaves and at the step from one to the next. Leaves meet only while they hold a point
        that is ``sought``, which may change in between.
        """
        if spanning:
            leaves = [(i, i) for i in range(len(self.leaves))] + [(i, i + 1) for i in range(len(self.leaves) - 1)]
        else:
            leaves = self.meeting_leaves(sought)
        for p, q in leaves:
            x, y = self.order[slice(*self.leaves[p])], self.order[slice(*self.leaves[q])]
            if sought is not None and not (sought[x].any() or sought[y].any()):
                continue
            if spanning and p != q:
                x, y = x[-1:], y[:1]
            a, b = np.repeat(x, len(y)), np.tile(y, len(x))
            if p == q:
                upper = np.repeat(np.arange(len(x)), len(y)) < np.tile(np.arange(len(y)), len(x))
                a, b = a[upper], b[upper]
            apart = self.parts[a] != self.parts[b]
            yield a[apart], b[apart]


def passing(points: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs reach the bound, and by how much of their size."""
    spare = np.empty(len(a))
    for block in np.array_split(np.arange(len(a)), len(a) // 4096 + 1):
        i, j = a[block], b[block]
        total = sizes[i] + sizes[j]
        spare[block] = (9 * np.minimum(points[i], points[j]).sum(1, dtype=np.int64) - 4 * total) / total
    return spare >= 0, spare


class _Slot:
    """The points of a slot, and the sets of them that met."""

    def __init__(self, met: pd.DataFrame, points: pd.DataFrame):
        points = points.sort_values("cid").reset_index(drop=True)
        self.ids, self.sizes, self.parts = (points[c].to_numpy(np.int64) for c in ("cid", "n", "part"))
        self.vectors = unpacked(points["vector"].tolist())
        self.met = met["members"]

    def candidates(self, spanning: bool, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
        """Pairs of points in different components that reach the bound, and by how much; some more than once.

        With ``known``, which the caller marks as pairs come, pairs of two known points may be left out: a large set is
        looked through for points still unknown, the nearest pairs first.
        """
        small_a, small_b, large = [], [], []
        for members in self.met:
            own = np.searchsorted(self.ids, np.asarray(members, np.int64))
            own = own[own < len(self.ids)]
            own = own[np.isin(self.ids[own], members)]
            if len(own) < 2 or (self.parts[own] == self.parts[own[0]]).all():
                continue
            if len(own) <= 2 * LEAF:
                a, b = np.triu_indices(len(own), 1)
                small_a.append(own[a])
                small_b.append(own[b])
                continue
            large.append(own)
        for own in self._together(large):
            tree = CountTree(self.vectors[own], self.sizes[own], self.parts[own])
            for near in (True, False) if known is not None and not spanning else (spanning,):
                sought = None if known is None else ~known[own]
                if sought is not None and not sought.any():
                    break
                for a, b in tree.candidates(near, sought):
                    ok, spare = passing(tree.points, tree.sizes, a, b)
                    yield own[a[ok]], own[b[ok]], spare[ok]
                    if sought is not None:
                        sought[:] = ~known[own]
        if small_a:
            pairs = np.unique(np.concatenate(small_a) * len(self.ids) + np.concatenate(small_b))
            a, b = pairs // len(self.ids), pairs % len(self.ids)
            sizes = self.sizes
            apart = (self.parts[a] != self.parts[b]) & (5 * sizes[a] >= 4 * sizes[b]) & (5 * sizes[b] >= 4 * sizes[a])
            if known is not None:
                apart &= ~(known[a] & known[b])
            a, b = a[apart], b[apart]
            ok, spare = passing(self.vectors, sizes, a, b)
            yield a[ok], b[ok], spare[ok]


    def _together(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        """Unions of sets of points: pairs of many sets are then looked at once, and some that are in no set."""
        unions: list[np.ndarray] = []
        held = np.full(len(self.ids), -1)
        for own in sorted(sets, key=len, reverse=True):
            seen = held[own]
            shared = np.bincount(seen[seen >= 0], minlength=1)
            most = int(shared.argmax())
            if 2 * shared[most] >= len(own):
                whole = np.union1d(unions[most], own)
                if len(whole) <= max(TOGETHER, len(unions[most])):
                    unions[most] = whole
                    held[own] = most
                    continue
            held[own] = len(unions)
            unions.append(own)
        return unions


def _possible(met: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """The points that have any candidate at all."""
    slot = _Slot(met, points)
    marked = np.zeros(len(slot.ids), bool)
    for a, b, _ in slot.candidates(spanning=False, known=marked):
        marked[a] = marked[b] = True
    return pd.DataFrame({"slot": met["slot"].iloc[0] if len(met) else 0, "cid": slot.ids[marked]})


def _likeliest(spanning: bool, most: int):
    def run(met: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        """Per point its ``most`` likeliest partners in other components; ``more`` tells if there were others."""
        slot = _Slot(met, points)
        found = list(slot.candidates(spanning))
        if not sum(len(a) for a, _, _ in found):
            return pd.DataFrame({"a": [], "b": [], "more": []}).astype({"a": "int64", "b": "int64", "more": bool})
        a, b, spare = (np.concatenate([f[i] for f in found]) for i in range(3))
        a, b = np.minimum(a, b), np.maximum(a, b)
        _, once = np.unique(a * len(slot.ids) + b, return_index=True)
        a, b, spare = a[once], b[once], spare[once]
        ends, pair = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
        order = np.lexsort((pair, -np.tile(spare, 2), ends))
        first = np.searchsorted(ends[order], np.arange(len(slot.ids)))
        rank = np.arange(len(order)) - first[ends[order]]
        chosen = np.unique(pair[order[rank < most]])
        more = len(chosen) < len(a)
        return pd.DataFrame({"a": slot.ids[a[chosen]], "b": slot.ids[b[chosen]], "more": more})

    return run


# ------------------------------------------------------------------ verification

def _verify(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a hub and its partners that link; each text comes once per hub."""
    texts = pa.array(rows["text"].tolist(), pa.string())
    sets = [s for chunk in chunks(texts) for s in shingle_sets(chunk)]
    out = []
    for (_, _), places in rows.groupby(["hub", "part"], sort=False).indices.items():
        cids = rows["cid"].to_numpy()[places]
        hub = rows["hub"].to_numpy()[places[0]]
        own = sets[places[np.flatnonzero(cids == hub)[0]]]
        for place, cid in zip(places, cids):
            if cid != hub:
                other = sets[place]
                both = np.sort(np.concatenate([own, other]))
                shared = int((both[1:] == both[:-1]).sum())
                if 9 * shared >= 4 * (len(own) + len(other)):
                    out.append((hub, cid))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link. Hubs with many partners are split."""
    count = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN).alias("parts"))
    split = stored(pairs.join(count, "a").select(
        F.col("a").alias("hub"), "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")), "split")
    needs = split.select("hub", "part", F.col("b").alias("cid")).union(
        split.select("hub", "part", F.col("hub").alias("cid")).distinct())
    slots = max(1, math.ceil(split.count() / VERIFY_ROWS))
    rows = needs.join(texts, "cid").withColumn("slot", F.pmod(F.xxhash64("hub", "part"), F.lit(slots)))
    return rows.groupBy("slot").applyInPandas(_verify, "a bigint, b bigint")


# ------------------------------------------------------------------ the join

def _texts_of(bits):
    """Texts of documents whose id may be among the wanted ones (or is null), with their class: a row may share its id
    with others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            keep = holds(bits.value, np.asarray(ids.fill_null(0), np.int64)) | np.asarray(ids.is_null())
            batch = batch.filter(pa.array(keep))
            for chunk in chunks(batch.column(1)):
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                ones = [int(np.bitwise_xor.reduce(tokens, initial=np.uint64(0)).view(np.int64))
                        for tokens in shingle_sets(chunk)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ones, pa.int64())], ["doc_id", "text", "own"])

    return run


@frees_shuffles
def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) per row of ``docs``.

    Needs doc_id and text. Null texts and texts without words have no shingles and only their own id; rows with
    equal sets link. A null doc_id takes part, but never names a component of others. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(commonness(docs))
    sketches = stored(docs.select("doc_id", "text").mapInArrow(
        _sketches(common), "doc_id bigint, one bigint, two bigint, n bigint, firsts binary, vector binary"),
        "sketches")
    classes = stored(sketches.filter("n > 0").groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("least"), F.first("firsts").alias("firsts"), F.first("vector").alias("vector"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    tokens = classes.agg(F.sum(F.length("firsts")) / 8).first()[0] or 0
    shards = max(1, math.ceil(tokens / SHARD_TOKENS))
    posted = classes.select("cid", "n", "firsts").mapInArrow(
        _post(shards), "shard bigint, tokens binary, which binary, ids binary, sizes binary")
    met = posted.groupBy("shard").applyInPandas(_meet, "digest bigint, least bigint, members array<bigint>")
    met = stored(met.groupBy("digest", "least").agg(F.first("members").alias("members")), "met")
    slots = max(1, math.ceil(met.count() / SLOT_SETS))
    met = met.select(F.pmod(F.xxhash64("least"), F.lit(slots)).alias("slot"), "members")
    points = met.select(F.col("slot").alias("at"), F.explode("members").alias("cid")).distinct().join(
        classes.select("cid", "vector", "n"), "cid").select(F.col("at").alias("slot"), "cid", "vector", "n",
                                                            F.col("cid").alias("part"))
    places = stored(met.groupBy("slot").cogroup(points.groupBy("slot")).applyInPandas(
        _possible, "slot bigint, cid bigint"), "places")
    met = met.join(places.select("slot").distinct(), "slot", "left_semi")
    # only what has a candidate goes on
    wanted = stored(places.select("cid").distinct().join(
        classes.select("cid", "least", "one", "vector", "n"), "cid"), "wanted")
    # one step in Python: each further one of a stage has a worker of its own, which stays when the stage is done
    may_be = docs.select("doc_id", "text").mapInArrow(
        _texts_of(spark.sparkContext.broadcast(bitset(wanted.select("least")))), "doc_id bigint, text string, own bigint")
    texts = stored(wanted.select("cid", "least", "one").alias("w").join(
        may_be.alias("d"), F.col("w.least").eqNullSafe(F.col("d.doc_id")) & (F.col("w.one") == F.col("d.own"))).select(
            "cid", "text").dropDuplicates(["cid"]), "texts")
    # from a range: rows handed over by the driver start Python workers of another kind
    links, roots = (spark.range(0).selectExpr(f"id as {x}", f"id as {y}") for x, y in (("a", "b"), ("node", "root")))
    tested, most, spanning = links, 1, True
    while True:
        points = places.join(wanted.select("cid", "vector", "n"), "cid").join(
            roots, F.col("cid") == F.col("node"), "left").select(
                "slot", "cid", "vector", "n", F.coalesce("root", "cid").alias("part"))
        likely = stored(met.groupBy("slot").cogroup(points.groupBy("slot")).applyInPandas(
            _likeliest(spanning, most), "a bigint, b bigint, more boolean"), "likely")
        new = stored(likely.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "new")
        if new.limit(1).count():
            tested = stored(tested.union(new), "tested")
            links = stored(links.union(linked(new, texts)), "links")
            roots = connected(links)
        elif not spanning and not likely.filter("more").limit(1).count():
            break
        most, spanning = (4 if spanning else most * 8), False
    named = classes.select("one", "two", "n", "cid", "least").join(
        roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(ids, "root").select("one", "two", "n", "component_id")
    return sketches.select("doc_id", "one", "two", "n").join(by_class, ["one", "two", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that link to one with a smaller doc_id, directly or by others.

    Rows that share a doc_id stay or go together; rows without one stay.
    """
    gone = stored(join(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    # the row travels as one struct, so that no column of it can clash
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id")).join(gone, "id", "left_anti").select("row.*")
