"""Runs of repeated words in a text, by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton whose tree of suffix links is held in a link-cut
tree. Every preferred path has one colour: the place where its strings last ended. Access from
the state of the text so far walks the path to the root and recolours it; where it comes upon a path of another
colour, the string of its deepest state ended there and ends here too, and is the longest that does.
Where the two ends are no farther apart than that string is long, it makes a square; its left end is
that of the run, and the last place that yields the same start and period is its right end.

Before that, words outside any stretch in which every few words occur twice are set aside, since all of a
run's do; this only saves work.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.text import Chunk, chunks, mix, release_memory, runs

#: A run is at least so many words and so many periods long.
LEAST_WORDS = 6
LEAST_PERIODS = 4
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: (doc_id, number of words) -> which word stands at each place, or None for the text as it is.
Pick = Callable[[int | None, int], np.ndarray | None]


class Automaton:
    """A suffix automaton that tells, for every appended word, where and how far back its suffixes ended before."""

    def __init__(self) -> None:
        self.moves: list[dict] = [{}]
        self.link, self.length, self.end = [-1], [0], 0
        self.last = 0
        # splay trees of the preferred paths, shallow states on the left; the colour is held by a tree's root
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]

    def _new(self, moves: dict, length: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        for column in (self.link, self.left, self.right, self.up, self.colour):
            column.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        first = True
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            if first:
                root = p
                while (above := up[root]) >= 0 and (left[above] == root or right[above] == root):
                    root = above
                self.colour[x], first = self.colour[root], False
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved >= 0:
            up[moved] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _copy(self, state: int, length: int) -> int:
        """Splits a state: the copy takes its shorter strings and its place above it on the same path."""
        copy = self._new(dict(self.moves[state]), length)
        self.link[copy], self.link[state] = self.link[state], copy
        self._splay(state)
        above = self.left[copy] = self.left[state]
        if above >= 0:
            self.up[above] = copy
        self.left[state], self.up[copy] = copy, state
        return copy

    def append(self, word) -> Iterator[tuple[int, int]]:
        """(distance, length) of the longest suffix that ended so far back, the nearest end first."""
        moves, link, length = self.moves, self.link, self.length
        state = self._new({}, length[self.last] + 1)
        p, self.last = self.last, state
        while p >= 0 and word not in moves[p]:
            moves[p][word] = state
            p = link[p]
        if p < 0:
            link[state] = 0
        else:
            target = moves[p][word]
            if length[target] > length[p] + 1:
                copy = self._copy(target, length[p] + 1)
                while p >= 0 and moves[p].get(word) == target:
                    moves[p][word] = copy
                    p = link[p]
                target = copy
            link[state] = target
        self.up[state] = link[state]
        yield from self._access(state)
        self.end += 1

    def _access(self, state: int) -> Iterator[tuple[int, int]]:
        right, up, colour, length = self.right, self.up, self.colour, self.length
        path, above = state, up[state]
        while above >= 0:
            self._splay(above)
            ended, deeper = colour[above], right[above]
            if length[above]:
                yield self.end - ended, length[above]
            if deeper >= 0:
                colour[deeper] = ended
            right[above] = path
            path, above = above, up[above]
        colour[path] = self.end
        self._splay(state)


def runs_of(words: Sequence, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple]:
    """(start, length, period) of the runs, by start, then by period."""
    automaton, last = Automaton(), {}
    for end, word in enumerate(words):
        for distance, length in automaton.append(word):
            if length >= (least_periods - 1) * distance and length + distance >= least_words:
                last[end - distance - length + 1, distance] = end
    return sorted((start, end - start + 1, period) for (start, period), end in last.items())


def periodic_stretches(chunk: Chunk, hashes: np.ndarray, least_words: int, least_periods: int) -> Iterator[tuple]:
    """(row, from, to) of the stretches, in words of the row, outside of which no run can have a word.

    Within a run each group of ``size`` words occurs again, a period away; groups that do not are cut
    out, and again those that do not in what is left between two cuts.
    """
    # in a run of length n and period q all groups of up to n - 2 * q + 1 words occur a period before or after
    short = least_words // least_periods
    size = min([(least_periods - 2) * (short + 1) + 1] + [least_words - 2 * short + 1] * (short > 0))
    grams, row = runs(hashes, size), chunk.rows_of_words()
    if not len(grams):
        return
    at = np.flatnonzero(row[:len(grams)] == row[size - 1:])
    part = row[at]
    while len(at):
        _, which, count = np.unique(mix(grams[at] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                                    return_inverse=True, return_counts=True)
        kept = at[count[which] > 1]
        settled, at = len(kept) > 0.9 * len(at), kept
        cuts = (np.diff(at, prepend=-9) != 1) | (np.diff(row[at], prepend=-1) != 0)
        part = np.cumsum(cuts)
        if settled:
            break
    if len(at):
        firsts = np.flatnonzero(cuts)
        lasts = np.append(firsts[1:], len(at)) - 1
        for first, last in zip(at[firsts], at[lasts] + size):
            if last - first >= least_words:
                offset = chunk.offsets[row[first]]
                yield int(row[first]), int(first - offset), int(last - offset)


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places for every tenth document by checksum of its id: from some word on, a stretch over and over."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % period
    return places


def find(docs: DataFrame, pick: Pick | None = None, least_words: int = LEAST_WORDS,
         least_periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, runs (start, length, period) and collapsed per row of ``docs``; needs doc_id and text.

    A run is a stretch of words with a smallest period, ``least_periods`` of it and ``least_words`` long at least,
    that no word beside it extends; runs come by start, then by period. Collapsed are the words less those
    that any run holds after its first period, joined by a space. ``pick`` puts other words of the text in place first.
    Null and empty texts have no runs and are empty; runs that overlap or tie are listed each; rows that repeat,
    and rows without an id, come out each; an empty table gives no rows; other columns take no part, whatever
    their names. Texts are read whole, whatever their length: a text's longest periodic stretch, at about a
    kilobyte a word, is what a task must hold.
    """
    if least_periods < 2:
        raise ValueError("a run repeats at least once")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1)):
                hashes, places = chunk.hashes(), {}
                for row in range(chunk.last - chunk.first) if pick else ():
                    first, last = chunk.offsets[row], chunk.offsets[row + 1]
                    chosen = pick(ids[chunk.first + row], int(last - first))
                    if chosen is not None:
                        places[row], hashes[first:last] = chosen, hashes[first + chosen]
                found: dict[int, list] = {}
                stretches: dict[int, list] = {}
                for row, first, last in periodic_stretches(chunk, hashes, least_words, least_periods):
                    stretches.setdefault(row, []).append((first, last))
                collapsed, data = [], chunk.data.tobytes()
                for row in range(chunk.last - chunk.first):
                    # the same words as the chunk's: bytes split at space and 0x09-0x0D
                    words = data[chunk.bounds[row]:chunk.bounds[row + 1]].split()
                    if row in places:
                        words = [words[i] for i in places[row].tolist()]
                    if row in stretches:
                        own = found[row] = [(first + start, length, period) for first, last in stretches[row]
                                            for start, length, period in runs_of(words[first:last], least_words,
                                                                                 least_periods)]
                        keep = np.ones(len(words), bool)
                        for start, length, period in own:
                            keep[start + period:start + length] = False
                        words = [words[i] for i in np.flatnonzero(keep).tolist()]
                    collapsed.append(b" ".join(words).decode())
                listed = [[dict(zip(("start", "length", "period"), r)) for r in found.get(row, ())]
                          for row in range(chunk.last - chunk.first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.last - chunk.first).cast(pa.int64()),
                     pa.array(listed, _RUNS_ARROW), pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])
            release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, runs {_RUNS}, collapsed string")


def _longest(runs_column: str) -> Column:
    order = F.transform(runs_column, lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"]))
    return F.array_min(order)


def collapse(docs: DataFrame, **options) -> DataFrame:
    """doc_id and collapsed text per row of ``docs``, as ``find`` gives them."""
    return find(docs, **options).select("doc_id", F.col("collapsed").alias("text"))


def summary(found: DataFrame) -> DataFrame:
    """One row per row of ``find``: the number of runs, the longest one and digests of all and of what is left.

    Of equally long runs the one with the least start, then period, is told; without any its four columns are null.
    """
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", _longest("runs"))
    length = -F.col("best.l")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
