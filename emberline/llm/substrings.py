"""Repeated passages by FM-indexes over routed pieces of the corpus.

Of the 8-word runs in a window of 35 words the one with the least hash is its anchor. Equal windows have equal
anchors, so a window can only repeat where its anchor does, and all windows of an anchor
meet in one shard. A document is cut into pieces, one per stretch of windows with the same
repeated anchor. Equal pieces are repeated as a whole; of each different one a copy goes into the shard's FM-index,
and all copies are streamed through it by backward search, which tells the stretches of
windows that occur at least twice. An anchor with a great share of all places does not go to one
shard: its windows are counted one by one by their hash, added up before they are sent.

Documents with the same words as another are repeated as a whole and take part once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.bitset import only
from emberline.llm.components import frees_shuffles, stored
from emberline.llm.fmindex import FMIndex, repeated
from emberline.llm.text import Chunk, chunks, mix, runs

WINDOW = 35
ANCHOR = 8
SHARD_ENTRIES = 2_000_000
SHARD_WORDS = 1_500_000
#: An anchor is hot beyond this share of all places, and at least this number.
HOT_SHARE = 1e-6
HOT_PLACES = 2_000
STREAM = 256
_PLACE_BITS = 26


def _least_places(keys: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` keys in a row, by blocks of that size."""
    blocks = -(-len(keys) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    shaped = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    last = len(keys) - span + 1
    return np.minimum(behind[:last], ahead[span - 1:span - 1 + last])


def anchors(chunk: Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, place of the anchor, its hash) of every window inside one row."""
    grams = runs(words, ANCHOR)
    if len(words) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    least = (_least_places((grams & ~low) | place, WINDOW - ANCHOR + 1) & low).astype(np.int64)
    row = chunk.rows_of_words()
    first = np.flatnonzero(row[:len(least)] == row[WINDOW - 1:WINDOW - 1 + len(least)])
    return first, least[first], grams[least[first]]


def fingerprints(chunk: Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's whole word sequence."""
    rows = chunk.last - chunk.first
    one, two = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    sizes = np.diff(chunk.offsets)
    full = np.flatnonzero(sizes)
    if len(full):
        at = np.arange(len(words)) - np.repeat(chunk.offsets[:-1], sizes)
        placed = mix(words ^ mix(at.astype(np.uint64) + np.uint64(1)))
        one[full] = np.add.reduceat(placed, chunk.offsets[:-1][full])
        two[full] = np.bitwise_xor.reduceat(mix(placed + np.uint64(3)), chunk.offsets[:-1][full])
    return one.view(np.int64), two.view(np.int64)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word count, fingerprint, digest of all words, and the anchors: each once, or twice if it has more places."""
    for batch in batches:
        texts = batch.column(1)
        for chunk in chunks(texts):
            words = chunk.hashes()
            one, two = fingerprints(chunk, words)
            first, place, hashed = anchors(chunk, words)
            new = np.ones(len(place), bool)
            new[1:] = place[1:] != place[:-1]
            row = np.searchsorted(chunk.offsets, first[new], "right") - 1
            hashed = hashed[new]
            order = np.lexsort((hashed, row))
            row, hashed = row[order], hashed[order]
            third = np.zeros(len(row), bool)
            third[2:] = (row[2:] == row[:-2]) & (hashed[2:] == hashed[:-2])
            row, hashed = row[~third], hashed[~third]
            cuts = np.searchsorted(row, np.arange(chunk.last - chunk.first + 1))
            raw = chunk.data.tobytes()
            ends = chunk.bounds.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[chunk.first:chunk.last], pa.array(one), pa.array(two),
                 pa.array(np.diff(chunk.offsets)),
                 pa.array([_digest(raw[a:b].split()) for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                 pa.array([hashed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                ["doc_id", "one", "two", "n", "whole", "anchors"])


# ------------------------------------------------------------------ packed rows by shard

def _by_shard(key: np.ndarray, shards: int, columns: dict[str, np.ndarray]) -> Iterator[dict]:
    """One row per shard with the bytes of its part of each column."""
    shard = (mix(key) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[k]:cuts[k + 1]]
        yield {"shard": k, **{name: values[own].tobytes() for name, values in columns.items()}}


def _packed(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], pa.int64() if n in ("shard", "cid") else pa.binary()) for n in names], names)


def _unpacked(rows: pd.DataFrame, name: str, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.frombuffer(v, kind) for v in rows[name]]) if len(rows) else np.empty(0, kind)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The class and the hash of every anchor in a batch of (cid, anchors)."""
    lists = batch.column(1).to_pylist()
    cids = np.repeat(np.array(batch.column(0).to_pylist(), np.int64), [len(x) // 8 for x in lists])
    return cids, np.frombuffer(b"".join(lists), np.uint64)


def _count(shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed, counts = np.unique(_lists(batch)[1], return_counts=True)
            yield _packed(list(_by_shard(hashed, shards, {"hashes": hashed, "counts": counts})),
                          ["shard", "hashes", "counts"])

    return run


def _hot(limit: float) -> Callable:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        hashed, which = np.unique(_unpacked(rows, "hashes", np.uint64), return_inverse=True)
        counts = np.bincount(which, _unpacked(rows, "counts"))
        return pd.DataFrame({"hash": hashed[counts > limit].view(np.int64)})

    return run


def _post(shards: int, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, hashed = _lists(batch)
            cold = ~np.isin(hashed, hot.value)
            yield _packed(list(_by_shard(hashed[cold], shards, {"hashes": hashed[cold], "cids": cids[cold]})),
                          ["shard", "hashes", "cids"])

    return run


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Per class its anchors that have a second place anywhere."""
    hashed, cids = _unpacked(rows, "hashes", np.uint64), _unpacked(rows, "cids")
    order = np.lexsort((cids, hashed))
    hashed, cids = hashed[order], cids[order]
    same = hashed[1:] == hashed[:-1]
    many = np.zeros(len(hashed), bool)
    many[1:] |= same
    many[:-1] |= same
    cids, hashed = cids[many], hashed[many]
    order = np.argsort(cids, kind="stable")
    cids, hashed = cids[order], hashed[order]
    own, cuts = np.unique(cids, return_index=True)
    return pd.DataFrame({"cid": own, "hashes": [h.tobytes() for h in np.split(hashed, cuts[1:])] if len(own) else []})


def _holders(hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, hashed = _lists(batch)
            own = np.unique(cids[np.isin(hashed, hot.value)])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([b""] * len(own), pa.binary())], ["cid", "hashes"])

    return run


# ------------------------------------------------------------------ pieces and windows

def _own_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only the texts with the words of their class: a row may share its id with others."""
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            one, two = fingerprints(chunk, chunk.hashes())
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            same = [a == b and c == d for a, b, c, d in zip(
                one.tolist(), part.column(2).to_pylist(), two.tolist(), part.column(3).to_pylist())]
            yield part.select(["cid", "text", "hashes"]).filter(pa.array(same, pa.bool_()))


def _marked(batch: pa.RecordBatch, hot: np.ndarray) -> Iterator[tuple]:
    """Per chunk the words, the class of each row, and its windows with a repeated or a hot anchor."""
    for chunk in chunks(batch.column(1)):
        words = chunk.hashes()
        first, _, hashed = anchors(chunk, words)
        row = np.searchsorted(chunk.offsets, first, "right") - 1
        lists = batch.column(2)[chunk.first:chunk.last].to_pylist()
        # a hash stands for its row: repeated anchors of one row say nothing of another
        wanted = np.concatenate([mix(np.frombuffer(b"".join(x), np.uint64) ^ mix(np.uint64([i]))) for i, x in
                                 enumerate(lists)])
        is_hot = np.isin(hashed, hot)
        cold = ~is_hot & np.isin(mix(hashed ^ mix(row.astype(np.uint64))), wanted)
        cids = np.array(batch.column(0)[chunk.first:chunk.last].to_pylist(), np.int64)
        yield chunk, words, cids, row, first, hashed, cold, is_hot


def _pieces(shards: int, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, cids, row, first, hashed, cold, _ in _marked(batch, hot.value):
                row, first, hashed = row[cold], first[cold], hashed[cold]
                if not len(first):
                    continue
                new = np.ones(len(first), bool)
                new[1:] = (first[1:] != first[:-1] + 1) | (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
                start = np.flatnonzero(new)
                last = np.append(start[1:], len(first)) - 1
                size = first[last] - first[start] + WINDOW
                shard = (mix(hashed[start]) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                out = []
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    own = order[cuts[k]:cuts[k + 1]]
                    at = np.repeat(first[start[own]] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
                    out.append({"shard": k, "words": words[at].tobytes(), "sizes": size[own].tobytes(),
                                "cids": cids[row[start[own]]].tobytes(),
                                "starts": (first[start[own]] - chunk.offsets[row[start[own]]]).tobytes()})
                yield _packed(out, ["shard", "words", "sizes", "cids", "starts"])

    return run


def _spans(cids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """One row per class with its stretches."""
    order = np.argsort(cids, kind="stable")
    cids, starts, ends = cids[order], starts[order], ends[order]
    own, cuts = np.unique(cids, return_index=True)
    if not len(own):
        return pd.DataFrame({"cid": np.empty(0, np.int64), "starts": [], "ends": []})
    return pd.DataFrame({"cid": own, "starts": [s.astype(np.int64).tobytes() for s in np.split(starts, cuts[1:])],
                         "ends": [e.astype(np.int64).tobytes() for e in np.split(ends, cuts[1:])]})


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Stretches of repeated windows in the pieces of one shard."""
    words, sizes = _unpacked(rows, "words", np.uint64), _unpacked(rows, "sizes")
    cids, starts = _unpacked(rows, "cids"), _unpacked(rows, "starts")
    offsets = np.cumsum(sizes) - sizes
    at = np.arange(len(words)) - np.repeat(offsets, sizes)
    piece = np.add.reduceat(mix(words ^ mix(at.astype(np.uint64))), offsets) + sizes.astype(np.uint64)
    _, once, copies = np.unique(piece, return_index=True, return_counts=True)
    _, which = np.unique(piece, return_inverse=True)
    whole = copies[which] > 1
    covered = [(cids[whole], starts[whole], starts[whole] + sizes[whole])]
    # one copy of each piece; pieces of one document that overlap become one, so that no place is there twice
    order = once[np.lexsort((starts[once], cids[once]))]
    reach, group, owner = -1, -1, None
    base = np.empty(len(order), np.int64)
    spans: list[list[int]] = []
    for i, k in enumerate(order.tolist()):
        if cids[k] != owner or starts[k] > reach:
            group, owner = group + 1, cids[k]
            spans.append([int(cids[k]), int(starts[k]), 0])
            reach = -1
        base[i] = starts[k] - spans[group][1]
        reach = max(reach, int(starts[k] + sizes[k]))
        spans[group][2] = reach - spans[group][1]
        spans[group].append(i)
    lengths = np.array([s[2] for s in spans])
    places = np.cumsum(lengths + 1) - lengths - 1
    _, numbers = np.unique(words, return_inverse=True)
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    target = np.repeat(places[np.repeat(np.arange(len(spans)), [len(s) - 3 for s in spans])] + base, sizes[order])
    own = sizes[order]
    inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    text[target + inside] = numbers[np.repeat(offsets[order], own) + inside] + 1
    index = FMIndex(text, int(numbers.max()) + 2)
    # long stretches are searched in parts that share a window less a word
    part_of, part_start, part_size = [], [], []
    for g, length in enumerate(lengths.tolist()):
        for a in range(0, max(1, length - WINDOW + 1), STREAM):
            part_of.append(g)
            part_start.append(a)
            part_size.append(min(length - a, STREAM + WINDOW - 1))
    part_of, part_start, part_size = map(np.array, (part_of, part_start, part_size))
    stream, a, b = repeated(index, places[part_of] + part_start, part_size, WINDOW)
    home = np.array([s[:2] for s in spans])[part_of[stream]] if len(stream) else np.empty((0, 2), np.int64)
    shift = home[:, 1] + part_start[stream] if len(stream) else np.empty(0, np.int64)
    covered.append((home[:, 0], shift + a, shift + b))
    return _spans(*(np.concatenate([c[i] for c in covered]) for i in range(3)))


def _windows(shards: int, hot) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of hot anchors: one entry per hash and batch; those known to repeat ask for no answer."""
        for batch in batches:
            hashes, owners, starts = [], [], []
            for chunk, words, cids, row, first, _, _, is_hot in _marked(batch, hot.value):
                every = runs(words, WINDOW)
                hashes.append(every[first[is_hot]])
                owners.append(cids[row[is_hot]])
                starts.append(first[is_hot] - chunk.offsets[row[is_hot]])
            if not sum(map(len, hashes)):
                continue
            hashed, owner, start = (np.concatenate(x) for x in (hashes, owners, starts))
            _, once, which, counts = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
            many = counts[which] > 1
            known = _spans(owner[many], start[many], start[many] + WINDOW)
            out = [{"shard": -1, "hashes": b"", "cids": s.starts, "starts": s.ends, "cid": s.cid}
                   for s in known.itertuples()]
            asked = np.where(counts > 1, -1, owner[once])
            for r in _by_shard(hashed[once], shards, {"hashes": hashed[once], "cids": asked, "starts": start[once]}):
                out.append({**r, "cid": -1})
            yield _packed(out, ["shard", "hashes", "cids", "starts", "cid"])

    return run


def _recurring(rows: pd.DataFrame) -> pd.DataFrame:
    hashed, cids, starts = _unpacked(rows, "hashes", np.uint64), _unpacked(rows, "cids"), _unpacked(rows, "starts")
    _, which, counts = np.unique(hashed, return_inverse=True, return_counts=True)
    asked = np.zeros(len(counts), bool)
    asked[which[cids < 0]] = True
    hit = (cids >= 0) & ((counts[which] > 1) | asked[which])
    return _spans(cids[hit], starts[hit], starts[hit] + WINDOW)


# ------------------------------------------------------------------ removal

def _removed(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for r in rows.itertuples():
        words = r.text.encode().split()
        edge = np.zeros(len(words) + 1, np.int64)
        for a, b in zip(r.starts, r.ends):
            np.add.at(edge, np.frombuffer(a, np.int64), 1)
            np.add.at(edge, np.frombuffer(b, np.int64), -1)
        gone = np.cumsum(edge[:-1]) > 0
        out.append((r.cid, int(gone.sum()), _digest([w for w, g in zip(words, gone) if not g])))
    return pd.DataFrame(out, columns=["cid", "removed", "kept"])


_SPANS = "cid bigint, starts binary, ends binary"


@frees_shuffles
def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the words left, joined by spaces) per row of ``docs``.

    A word goes if a window of 35 words of its document, the word among them, has the same words as one that starts
    anywhere else. Null and empty texts have no words; rows that repeat, or share a doc_id (null too), are documents
    of their own, so equal texts of 35 words or more lose all. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sketches = stored(docs.select("doc_id", "text").mapInArrow(
        _sketch, "doc_id bigint, one bigint, two bigint, n bigint, whole string, anchors binary"), "sketches")
    classes = stored(sketches.filter(F.col("n") >= WINDOW).groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("least"), F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    places = classes.agg(F.sum(F.length("anchors")) / 8).first()[0] or 0
    shards = max(1, math.ceil(places / SHARD_ENTRIES))
    lists = classes.select("cid", "anchors")
    limit = max(HOT_PLACES, places * HOT_SHARE)
    counted = lists.mapInArrow(_count(shards), "shard bigint, hashes binary, counts binary").groupBy("shard")
    # fewer than 1 / HOT_SHARE hashes
    hot_list = np.array([r[0] for r in counted.applyInPandas(_hot(limit), "hash bigint").collect()], np.int64)
    hot = spark.sparkContext.broadcast(np.sort(hot_list.view(np.uint64)))
    shared = lists.mapInArrow(_post(shards, hot), "shard bigint, hashes binary, cids binary").groupBy(
        "shard").applyInPandas(_shared, "cid bigint, hashes binary")
    if len(hot_list):
        shared = shared.union(lists.mapInArrow(_holders(hot), "cid bigint, hashes binary"))
    shared = stored(shared.groupBy("cid").agg(F.collect_list("hashes").alias("hashes")), "shared")
    wanted = stored(shared.join(classes.select("cid", "least", "one", "two"), "cid"), "wanted")
    texts = stored(wanted.alias("w").join(only(docs.select("doc_id", "text"), wanted.select("least")).alias("d"), F.col("w.least").eqNullSafe(
        F.col("d.doc_id"))).select("cid", "text", "one", "two", "hashes").mapInArrow(
            _own_class, "cid bigint, text string, hashes array<binary>").dropDuplicates(["cid"]), "texts")
    anchored = shared.agg(F.sum(F.aggregate("hashes", F.lit(0).cast("bigint"), lambda n, h: n + F.length(h)))).first()[0]
    index_shards = max(1, math.ceil((anchored or 0) / 8 * 48 / SHARD_WORDS))
    found = texts.mapInArrow(
        _pieces(index_shards, hot), "shard bigint, words binary, sizes binary, cids binary, starts binary").groupBy(
            "shard").applyInPandas(_search, _SPANS)
    if len(hot_list):
        windows = stored(texts.mapInArrow(_windows(shards, hot), "shard bigint, hashes binary, cids binary, "
                                          "starts binary, cid bigint"), "windows")
        found = found.union(windows.filter("shard < 0").selectExpr("cid", "cids as starts", "starts as ends")).union(
            windows.filter("shard >= 0").drop("cid").groupBy("shard").applyInPandas(_recurring, _SPANS))
    spans = stored(found.groupBy("cid").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends")),
                   "spans")
    changed = texts.select("cid", "text").join(spans, "cid").mapInPandas(
        lambda batches: map(_removed, batches), "cid bigint, removed bigint, kept string")
    by_class = classes.select("one", "two", "n", "cid", "copies").join(stored(changed, "changed"), "cid", "left")
    gone = (F.col("copies") > 1)
    return sketches.select("doc_id", "one", "two", "n", "whole").join(
        by_class.drop("cid"), ["one", "two", "n"], "left").select(
            "doc_id", F.col("n").alias("n_words"),
            F.when(gone, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))
