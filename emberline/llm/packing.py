"""Packing documents into training windows by the sum-of-squares rule.

Every scan task tokenizes its rows and packs them as they come. Whole windows
are cut off a document first; its rest goes to the fill level that keeps the
squared counts of partly filled windows smallest, looked up in one array of
counts per level. When a task has ``open_windows`` partly filled windows, or no
more rows, they are settled: the emptiest are cut to fill the fullest, and what
is left at the end becomes windows whose lengths are powers of two. So nothing is
padded, no shuffle is needed, and a task holds a bounded number of ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from emberline.llm.text import Chunk, chunks, release_memory

WINDOW = 2048
OPEN_WINDOWS = 2048
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
_KNOWN_WORDS = 400_000
_JOINED = 1000
#: Stretches are told apart per chunk: larger ones repeat more.
CHUNK_BYTES = 1 << 20
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_OTHER_ASCII = np.array([b < 128 and not _LETTER[b] and b not in b" \t\n\r\x0b\x0c" for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Second bytes after 0xC3 that are letters (all but the signs of multiplication and division).
_LATIN = np.array([128 <= b < 192 and b not in (0x97, 0xB7) for b in range(256)])


def simplified(chunk: Chunk) -> Chunk:
    """The same chunk in fewer different stretches, without changing their ids.

    The vocabulary starts anew between a letter and an ASCII character that is none, and it ignores case, for
    which ASCII needs no context.
    """
    data = chunk.data
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    cut = np.zeros(len(data), bool)
    cut[1:] = letter[:-1] & _OTHER_ASCII[data[1:]]
    cut[chunk.bounds[chunk.bounds < len(data)]] = False
    cuts = np.flatnonzero(cut)
    starts, ends = np.sort(np.concatenate([chunk.starts, cuts])), np.sort(np.concatenate([chunk.ends, cuts]))
    wide = np.concatenate([[0], np.cumsum(data >= 128)])
    plain = wide[starts] == wide[ends]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[plain]] += 1
    edges[ends[plain]] -= 1
    lower = np.where(np.cumsum(edges[:-1], dtype=np.int8).view(bool), _LOWER[data], data)
    return Chunk(chunk.first, chunk.last, lower, chunk.bounds, starts, ends, np.searchsorted(starts, chunk.bounds))


class Vocabulary:
    """Ids by whitespace-free stretch of text; the vocabulary never joins two of them.

    Each distinct stretch is tokenized once while it is known, many at a time with a special token
    between them.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        special = [(n, t.content) for n, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark_id, self.mark = special[0] if special else (None, "")
        self.specials = [text.encode() for _, text in special]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, words: list[bytes], special: bool) -> None:
        special = special or self.mark_id is None
        alone = {w for w in words if self.mark_id is None or any(s in w for s in self.specials)} if special else set()
        joined = [w for w in words if w not in alone] if alone else words
        alone = list(alone)
        texts = [self.mark.join(w.decode() for w in joined[i:i + _JOINED]) for i in range(0, len(joined), _JOINED)]
        pool, sizes = [self.pool], [self.sizes]
        # one text after another: what the tokenizer tells besides ids takes several times the room of the text
        for text in texts:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == self.mark_id)
            sizes.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
            pool.append(ids[ids != self.mark_id])
        for word in alone:
            ids = np.array(self.tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids, np.uint32)
            sizes.append(np.array([len(ids)]))
            pool.append(ids)
        self.known.update(zip(joined + alone, range(len(self.known), len(self.known) + len(words))))
        self.pool, self.sizes = np.concatenate(pool), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ids(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's rows, and where each row's begin (with the end)."""
        raw = chunk.data.tobytes()
        special = any(s in raw for s in self.specials)
        if not special:
            chunk = simplified(chunk)
            raw = chunk.data.tobytes()
        _, first, which = np.unique(chunk.hashes(), return_index=True, return_inverse=True)
        words = [raw[s:e] for s, e in zip(chunk.starts[first].tolist(), chunk.ends[first].tolist())]
        if len(self.known) > _KNOWN_WORDS:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new, special)
        entry = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[which]
        sizes = self.sizes[entry]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[entry] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.pool[at], np.concatenate([[0], ends])[chunk.offsets]


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(definition: str) -> Vocabulary:
    key = zlib.crc32(definition.encode())
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(definition)
    return _loaded[key]


class Levels:
    """Open windows by fill level, and the pieces in them."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.at: list[list[list]] = [[] for _ in range(window + 1)]

    def __len__(self) -> int:
        return int(self.count.sum())

    def choose(self, size: int) -> int:
        """The level (0: a new window) at which a piece adds least to the squares; ties to the fullest."""
        high = self.window - size
        levels = np.flatnonzero(self.count[1:high + 1]) + 1
        best, change = 0, 2 * int(self.count[size]) + 1
        if len(levels):
            to = levels + size
            growth = np.where(to < self.window, 2 * self.count[to] + 1, 0)
            changes = growth - 2 * self.count[levels] + 1
            place = len(levels) - 1 - int(np.argmin(changes[::-1]))
            if changes[place] <= change:
                best = int(levels[place])
        return best

    def place(self, piece: tuple) -> list | None:
        """Put a piece of less than a window; returns the window if that fills it."""
        size = len(piece[2])
        level = self.choose(size)
        if level:
            pieces = self.at[level].pop()
            self.count[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.at[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def settle(self) -> Iterator[list]:
        """Fill the fullest windows from the emptiest, then cut the rest into powers of two."""
        opened = [(level, pieces) for level in range(self.window, 0, -1) for pieces in self.at[level]]
        self.__init__(self.window)
        low, spare = len(opened), []
        for high in range(len(opened)):
            if high >= low:
                break
            fill, pieces = opened[high]
            while fill < self.window and (spare or low > high + 1):
                if not spare:
                    low -= 1
                    spare = opened[low][1]
                taken, spare = _take(spare, self.window - fill)
                pieces.extend(taken)
                fill += sum(len(piece[2]) for piece in taken)
            if fill < self.window:
                spare = pieces
                break
            yield pieces
        rest = sum(len(piece[2]) for piece in spare)
        while rest >= self.window:
            taken, spare = _take(spare, self.window)
            rest -= self.window
            yield taken
        while rest:
            power = 1 << (rest.bit_length() - 1)
            taken, spare = _take(spare, power)
            rest -= power
            yield taken


def _take(pieces: list, size: int) -> tuple[list, list]:
    """The first ``size`` ids of the pieces, and what is left of them."""
    taken, left = [], list(pieces)
    while size and left:
        doc, start, ids, total = left.pop(0)
        taken.append((doc, start, ids[:size], total))
        if len(ids) > size:
            left.insert(0, (doc, start + size, ids[size:], total))
        size -= len(taken[-1][2])
    return taken, left


class _Output:
    def __init__(self, task: int):
        self.sequence = task << 40
        self.rows: list[tuple] = []

    def add(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                              self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        columns = list(zip(*self.rows)) or [()] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(docs: DataFrame, tokenizer: str, end: int = 1, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece of a document in a window of at most ``window`` ids.

    ``docs`` has doc_id and text, other columns are ignored; ``tokenizer`` is the path of
    a vocabulary file that ignores white space. A null or empty text is its end id alone; rows
    that repeat, or have no doc_id, are packed one by one; an empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, levels, out = _vocabulary(definition.value), Levels(window), _Output(TaskContext.get().partitionId())
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1), CHUNK_BYTES):
                flat, bounds = words.ids(chunk)
                for i, doc in enumerate(docs[chunk.first:chunk.last]):
                    ids = np.append(flat[bounds[i]:bounds[i + 1]], np.uint32(end))
                    total, cut = len(ids), len(ids) - len(ids) % window
                    for start in range(0, cut, window):
                        out.add([(doc, start, ids[start:start + window], total)])
                    if total > cut:
                        filled = levels.place((doc, cut, ids[cut:].copy(), total))
                        if filled:
                            out.add(filled)
                    if len(levels) >= open_windows:
                        for pieces in levels.settle():
                            out.add(pieces)
                yield out.batch()
        for pieces in levels.settle():
            out.add(pieces)
        yield out.batch()
        # the worker may stay, idle, for other work; loading the vocabulary again takes a fraction of a second
        _loaded.clear()
        del words
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
