"""Personal data by a semi-Markov conditional random field.

A text is cut into atoms (letters, digits, single signs) around its digits and marks of addresses. Spans of
bounded length that could be an entity are candidate segments, scored as a whole: shape, numbers of digits and groups, check
digit, parts of an address, what stands beside them. Dynamic programming over segments chooses boundaries and types
together; every atom outside is a segment of its own. Weights are trained here, by the likelihood of the
segmentations that the base rules give for a bounded sample of windows, and for disguised copies of them that
the rules do not match (no plus, signs spelled out, other separators), and of copies with decoys (dates, amounts, wrong
check digits) in their place. What the base rules find is
always a candidate, with a bonus that nothing makes up for; the model adds what they miss.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.components import stored

KINDS = ("email", "ip", "card", "phone")
#: Bound of the fit: windows per kind, and as many without any, the first by hash of place and text over all documents.
WINDOWS = 400
EPOCHS = 6
RATE = 0.3
DECAY = 1e-4
#: Islands of segments that a feature must occur in to be learned.
SEEN = 4
#: What an entity costs before anything is learned.
PRIOR = -4.0
#: Most atoms of a number, and of an address before and after its sign, that the model may add.
ATOMS = 24
#: Characters of text around the digits and marks of a window, and the widest gap inside one.
AROUND = 48
GAP = 40
#: Windows in the sample have at most so many characters; longer ones are not learned from, but searched.
LONGEST_SAMPLE = 600
#: Longer windows are searched piece by piece; pieces overlap by more than a span, which counts where it starts.
PIECE = 16_384
OVERLAP = 4_096
_BONUS = 1e6
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
_SPANS_SQL = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"

# ------------------------------------------------------------------ base rules

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# a match can only start where a run of digits does, as no match ends inside one
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _octets(parts: Sequence[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        # the local part is the run of its characters before the sign, back to the last match at most
        first = at
        while first > done:
            back = max(done, first - 256)
            run = _LOCAL_END.search(_NOT_LOCAL.split(text[back:first])[-1])
            if not run:
                break
            first -= len(run.group())
            if first > back:
                break
        host = _HOST.match(text, at + 1) if first < at else None
        if host:
            yield first, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of what the base rules find, in order."""
    found = [(first, 0, last) for first, last in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _only_digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m.group())) <= 15]
    return sorted(found)


# ------------------------------------------------------------------ lattice

_CORE = re.compile(r"[0-9]+|@|[Dd][Oo][Tt](?![A-Za-z])")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^\W0-9_A-Za-z]+|\S")
_NUMBER_SIGNS = set("+().-,/[]")
_BRACKETS = set("[](){}<>")
_SHAPE = [(re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"[0-9]"), "9")]


@dataclass
class Segment:
    first: int              # atoms, end exclusive
    last: int
    kind: int               # 1 + number of the kind
    start: int              # code points
    end: int
    base: bool = False
    features: list[str] = field(default_factory=list)


def pieces(text: str) -> Iterator[tuple[int, int, int, int]]:
    """The windows, long ones cut; and from where to where a span that starts there is told by that piece."""
    for first, last in windows(text):
        at = first
        while last - at > PIECE + OVERLAP:
            yield at, at + PIECE + OVERLAP, at + OVERLAP // 2 * (at > first), at + PIECE + OVERLAP // 2
            at += PIECE
        yield at, last, at + OVERLAP // 2 * (at > first), last + 1


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text around its digits and marks of addresses."""
    first = last = None
    for core in _CORE.finditer(text):
        if first is not None and core.start() - last > GAP + 2 * AROUND:
            yield max(0, first - AROUND), min(len(text), last + AROUND)
            first = None
        first = core.start() if first is None else first
        last = core.end()
    if first is not None:
        yield max(0, first - AROUND), min(len(text), last + AROUND)


def _plain(char: str) -> bool:
    return char.isascii() and char.isalnum()


class Lattice:
    """Atoms of a window and the segments that could be entities."""

    def __init__(self, text: str, first: int, last: int, base: Sequence[tuple[int, int, int]] = ()):
        found = [m.span() for m in _ATOM.finditer(text, first, last)]
        self.text, self.starts, self.ends = text, [s for s, _ in found], [e for _, e in found]
        self.segments: list[Segment] = []
        known = set()
        places, closes = {s: i for i, s in enumerate(self.starts)}, {e: i + 1 for i, e in enumerate(self.ends)}
        for start, kind, end in base:
            if start in places and end in closes:
                self._add(places[start], closes[end], 1 + kind, True)
                known.add((places[start], closes[end], 1 + kind))
        for atom in range(len(found)):
            for i, j, kind in self._numbers(atom) if self._opens(atom) else ():
                if (i, j, kind) not in known:
                    self._add(i, j, kind)
            for i, j in self._addresses(atom):
                if (i, j, 1) not in known:
                    self._add(i, j, 1)
        self.segments.sort(key=lambda s: (s.first, s.last, s.kind))

    def _add(self, i: int, j: int, kind: int, base: bool = False) -> None:
        segment = Segment(i, j, kind, self.starts[i], self.ends[j - 1], base)
        segment.features = self._features(segment)
        self.segments.append(segment)

    def word(self, i: int) -> str:
        return self.text[self.starts[i]:self.ends[i]]

    def _gap(self, i: int) -> str:
        """What stands between an atom and the one before."""
        return self.text[self.ends[i - 1]:self.starts[i]]

    def _opens(self, i: int) -> bool:
        start = self.starts[i]
        return (self.text[start] in "+(" or self.text[start] in "0123456789") and not (
            start and _plain(self.text[start - 1]))

    def _closes(self, i: int) -> bool:
        end = self.ends[i]
        return not (end < len(self.text) and _plain(self.text[end]))

    def _numbers(self, i: int) -> Iterator[tuple[int, int, int]]:
        """Spans of digits and signs from an atom on, with the kinds they could be."""
        groups: list[str] = []
        dots, plain = 0, True
        for j in range(i, min(len(self.starts), i + ATOMS)):
            if j > i and not self._gap(j).strip(" ") == "" or j > i and len(self._gap(j)) > 2:
                return
            word = self.word(j)
            if word[0] in "0123456789" and word.isascii() and word.isdigit():
                groups.append(word)
                digits = sum(map(len, groups))
                if digits > 19 or len(groups) > 1 and dots < 0:
                    return
                if self._closes(j):
                    if 7 <= digits <= 15:
                        yield i, j + 1, 4
                    if plain and digits >= 12:
                        yield i, j + 1, 3
                    if len(groups) == 4 and dots == 3 and _octets(groups):
                        yield i, j + 1, 2
            elif word in _NUMBER_SIGNS:
                plain = plain and word in "-."
                dots += word == "."
            else:
                return

    def _mark(self, i: int, sign: str, name: str) -> tuple[int, bool] | None:
        """Atoms of a sign or its name from an atom on, and whether it is more than the bare name."""
        if self.word(i) == sign:
            return 1, True
        if self.word(i).lower() == name:
            return 1, False
        if i + 2 < len(self.starts) and self.word(i) in _BRACKETS and self.word(i + 2) in _BRACKETS and (
                self.word(i + 1) == sign or self.word(i + 1).lower() == name):
            return 3, True
        return None

    def _addresses(self, at: int) -> Iterator[tuple[int, int]]:
        """Spans around an atom that begins a mark between name and host."""
        mark = self._mark(at, "@", "at")
        if mark is None or at == 0:
            return
        length, clear = mark
        ends, j, need = [], at + length, True
        while j < min(len(self.starts), at + ATOMS):
            if need:
                if not _plain(self.word(j)[0]):
                    break
                while j + 1 < len(self.starts) and self._gap(j + 1) == "" and (
                        _plain(self.word(j + 1)[0]) or self.word(j + 1) == "-"):
                    j += 1
                if ends and self._closes(j):
                    ends.append(j + 1)
                ends = ends or [0]
                j, need = j + 1, False
            else:
                dot = self._mark(j, ".", "dot")
                if dot is None or not clear and self.word(j) == "." or self.word(j) == "." and self._gap(j) + (
                        self._gap(j + 1) if j + 1 < len(self.starts) else "") and self.word(at) == "@":
                    break
                j, need = j + dot[0], True
        for i in range(at - 1, max(-1, at - ATOMS // 2), -1):
            word = self.word(i)
            if not (_plain(word[0]) or word in "._%+-") or i < at - 1 and self._gap(i + 1):
                break
            if _plain(word[0]) and not (self.starts[i] and _plain(self.text[self.starts[i] - 1])):
                yield from ((i, end) for end in ends[1:])

    def _features(self, segment: Segment) -> list[str]:
        """What the whole span looks like and what stands beside it."""
        text, kind = self.text, segment.kind
        span = text[segment.start:segment.end]
        exact = span if len(span) <= 80 else span[:40] + span[-40:]
        for pattern, sign in _SHAPE:
            exact = pattern.sub(sign, exact)
        coarse = re.sub("9+", "9", exact)
        groups = _DIGITS.findall(span)
        digits = "".join(groups)
        before = self.word(segment.first - 1).lower()[:12] if segment.first else ""
        after = self.word(segment.last).lower()[:12] if segment.last < len(self.starts) else ""
        left = text[segment.start - 1] if segment.start else " "
        right = text[segment.end] if segment.end < len(text) else " "
        out = ["bias", f"coarse {coarse}", f"signs {''.join(sorted(set(re.sub('[a9]', '', exact))))}",
               f"atoms {min(segment.last - segment.first, 16)}", f"before {before}", f"after {after}",
               f"left {_side(left)}", f"right {_side(right)}"]
        if kind == 1:
            out += [f"end {min(len(re.split('[^A-Za-z]', span)[-1]), 8)}", f"marks {'@' in span} {'.' in span}"]
        else:
            out += [f"exact {exact}", f"digits {len(digits)}", f"groups {min(len(groups), 8)}", f"first {span[0] in '+('}",
                    f"sizes {max(map(len, groups), default=0) > 6}"]
            if kind == 3:
                out.append(f"check {luhn(digits)}")
        return [f"{kind} {f}" for f in out]


def _side(char: str) -> str:
    return "space" if char.isspace() else "letter" if char.isalpha() else "digit" if char.isdigit() else char


# ------------------------------------------------------------------ model

@dataclass
class Model:
    """Weights by feature; pairs of neighbouring labels (0 is outside) are features too."""

    weights: dict[str, float]

    def score(self, segment: Segment) -> float:
        own = self.weights
        return PRIOR + sum(own.get(f, 0.0) for f in segment.features) + (_BONUS if segment.base else 0.0)

    def pairs(self) -> list[list[float]]:
        labels = range(len(KINDS) + 1)
        return [[self.weights.get(f"pair {a} {b}", 0.0) for b in labels] for a in labels]

    def decode(self, lattice: Lattice) -> list[Segment]:
        """The segments of the best segmentation; in a tie fewer, longer, earlier kinds."""
        labels, pairs = len(KINDS) + 1, self.pairs()
        out: list[Segment] = []
        for first, last, segments in islands(lattice):
            opening: dict[int, list[tuple[float, Segment]]] = {}
            for segment in segments:
                opening.setdefault(segment.first, []).append((self.score(segment), segment))
            best = [[-math.inf] * labels for _ in range(last - first + 1)]
            back: list[list] = [[None] * labels for _ in range(last - first + 1)]
            best[0][0] = 0.0
            for at in range(first, last):
                own = best[at - first]
                steps = [(at + 1, 0, 0.0, None)] + [(s.last, s.kind, value, s) for value, s in opening.get(at, ())]
                for end, kind, value, segment in steps:
                    came = max(range(labels), key=lambda y: own[y] + pairs[y][kind])
                    total = own[came] + pairs[came][kind] + value
                    if total > best[end - first][kind]:
                        best[end - first][kind], back[end - first][kind] = total, (at, came, segment)
            at, label = last, max(range(labels), key=lambda y: best[-1][y] + pairs[y][0])
            while at > first:
                at, label, segment = back[at - first][label]
                if segment is not None:
                    out.append(segment)
        return out


def islands(lattice: Lattice) -> Iterator[tuple[int, int, list[Segment]]]:
    """Stretches of atoms with the segments in them, a free atom apart or more: they do not bear upon each other."""
    held: list[Segment] = []
    reach = 0
    for segment in lattice.segments:
        if held and segment.first > reach:
            yield held[0].first, reach, held
            held = []
        held.append(segment)
        reach = max(reach, segment.last) if len(held) > 1 else segment.last
    if held:
        yield held[0].first, reach, held


def _add_logs(values: Sequence[float]) -> float:
    most = max(values)
    return most if most == -math.inf else most + math.log(sum(math.exp(v - most) for v in values))


def gradient(model: Model, first: int, last: int, segments: Sequence[Segment], gold: set[tuple]) -> tuple[float, dict]:
    """Log-likelihood of the gold (first, last, kind) segments of an island, and its slope by feature."""
    labels, pairs, size = len(KINDS) + 1, model.pairs(), last - first
    edges = [(at, at + 1, 0, 0.0, None) for at in range(size)]
    edges += [(s.first - first, s.last - first, s.kind, model.score(s) - (_BONUS if s.base else 0.0), s) for s in segments]
    edges.sort(key=lambda e: (e[0], e[1], e[2]))
    forward = [[-math.inf] * labels for _ in range(size + 1)]
    forward[0][0] = 0.0
    for at, end, kind, value, _ in edges:
        total = value + _add_logs([forward[at][y] + pairs[y][kind] for y in range(labels)])
        forward[end][kind] = _add_logs([forward[end][kind], total])
    backward = [[-math.inf] * labels for _ in range(size + 1)]
    backward[size] = [pairs[y][0] for y in range(labels)]
    for at, end, kind, value, _ in reversed(edges):
        after = value + backward[end][kind]
        for y in range(labels):
            backward[at][y] = _add_logs([backward[at][y], pairs[y][kind] + after])
    whole = _add_logs([forward[size][y] + backward[size][y] for y in range(labels)])
    covered = {at for i, j, _ in gold for at in range(i - first, j - first)}
    slope: dict[str, float] = {}
    path, likelihood = [], -whole
    for at, end, kind, value, segment in edges:
        told = at not in covered if segment is None else (segment.first, segment.last, kind) in gold
        path += [(at, end, kind, value)] if told else []
        part = 0.0
        for y in range(labels):
            chance = forward[at][y] + pairs[y][kind] + value + backward[end][kind] - whole
            if chance > -30:
                chance = math.exp(chance)
                part += chance
                slope[f"pair {y} {kind}"] = slope.get(f"pair {y} {kind}", 0.0) - chance
        for f in segment.features if segment is not None else ():
            slope[f] = slope.get(f, 0.0) + told - part
    for y in range(labels):
        chance = forward[size][y] + backward[size][y] - whole
        if chance > -30:
            slope[f"pair {y} 0"] = slope.get(f"pair {y} 0", 0.0) - math.exp(chance)
    came = 0
    for _, _, kind, value in [*sorted(path), (size, size, 0, 0.0)]:
        likelihood += value + pairs[came][kind]
        slope[f"pair {came} {kind}"] = slope.get(f"pair {came} {kind}", 0.0) + 1
        came = kind
    return likelihood, slope


def train(samples: Sequence[tuple[str, Sequence[tuple[int, int, int]]]], epochs: int = EPOCHS) -> Model:
    """From (text, (start, kind, end) spans that do not overlap) windows, by steps scaled per feature."""
    model, squares, todo = Model({}), {}, []
    for text, spans in samples:
        lattice = Lattice(text, 0, len(text), spans)
        places = {(s.first, s.last, s.kind) for s in lattice.segments if s.base}
        for first, last, segments in islands(lattice):
            todo.append((first, last, segments, {p for p in places if first <= p[0] < last}))
    # words that hardly ever stand beside a span would only explain their own window
    met = Counter(f for island in todo for f in {f for s in island[2] for f in s.features})
    for island in todo:
        for segment in island[2]:
            segment.features = [f for f in segment.features if met[f] >= SEEN]
    order = random.Random(17)
    for _ in range(epochs):
        order.shuffle(todo)
        for island in todo:
            _, slope = gradient(model, *island)
            for f, step in slope.items():
                weight = model.weights.get(f, 0.0)
                step -= DECAY * weight
                squares[f] = squares.get(f, 1e-2) + step * step
                model.weights[f] = weight + RATE * step / math.sqrt(squares[f])
    return Model({f: w for f, w in model.weights.items() if abs(w) > 1e-4})


def disguised(span: str, kind: int, turn: int) -> str:
    """The span in a form that no base rule matches, of a few forms in turn."""
    if kind == 0:
        name, host = span.split("@")
        at, dot = ((" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) "))[turn % 4]
        return name + at + host.replace(".", dot)
    if kind == 1:
        return span.replace(".", ("[.]", " . ", "(.)")[turn % 3])
    if kind == 2:
        digits = _only_digits(span)
        sign = (".", "  ", " - ")[turn % 3]
        return sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    rest = re.sub(r"^\+[0-9]{1,3}[ .-]*(?=[^0-9 ])|^\+", "", span)
    return rest if turn % 2 else re.sub("[() -]+", "-", rest).strip("-")


def decoy(span: str, kind: int, turn: int) -> str:
    """A number of another meaning, made of the span's digits: no personal data."""
    digits = (_only_digits(span) * 16 + "123456789012")[:16]
    if kind == 2:
        return span[:-1] + str((int(span[-1]) + 1) % 10)
    day = f"{int(digits[4]) % 2}{int(digits[5]) % 9 + 1}", f"{int(digits[6]) % 3}{int(digits[7]) % 9 + 1}"
    return (f"{1 + int(digits[0]) % 2}9{digits[2:4]}-{day[0]}-{day[1]}", f"{day[1]}.{day[0]}.20{digits[2:4]}",
            f"{1 + int(digits[0]) % 9},{digits[1:4]},{digits[4:7]}", f"978-{digits[0]}-{digits[1:3]}-{digits[3:9]}-{digits[9]}",
            f"{digits[0]}.{digits[1]}.{digits[2]}", f"{day[1]}/{day[0]}/20{digits[2:4]}", digits[:7 + turn % 7],
            f"{digits[:3]} {digits[3:6]},{digits[6:8]}", " ".join(digits[:7 + turn % 9]),
            " ".join(digits[i:i + 2] for i in range(0, 14, 2)))[turn % 10]


def _gold(spans: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans that overlap, the longest."""
    out: list[tuple[int, int, int]] = []
    for start, kind, end in sorted(spans, key=lambda s: (s[0] - s[2], s)):
        if all(end <= other[0] or other[2] <= start for other in out):
            out.append((start, kind, end))
    return sorted(out)


def doubtful(text: str) -> bool:
    """Whether a rule's match has too many digits: it may be several entities, none of which the rules give."""
    return any(len(_only_digits(m.group())) > most for rule, most in ((_CARD, 19), (_PHONE, 15)) for m in rule.finditer(text))


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with the base spans in them, by the kind of the first one (or none)."""
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            if not text or not _CORE.search(text):
                continue
            spans = _gold(base_spans(text))
            for first, last in windows(text):
                own = [s for s in spans if s[0] < last and first < s[2]]
                first, last = min([first, *[s[0] for s in own]]), max([last, *[s[2] for s in own]])
                if last - first <= LONGEST_SAMPLE and not doubtful(text[first:last]):
                    out.append((text[first:last], KINDS[own[0][1]] if own else "",
                                [{"start": s - first, "kind": k, "end": e - first} for s, k, e in own]))
        yield pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
            pa.array([o[2] for o in out], pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()),
                                                                ("end", pa.int64())])))], ["piece", "kind", "spans"])


def fit(docs: DataFrame, per_kind: int = WINDOWS, epochs: int = EPOCHS) -> Model:
    """Weights from at most ``per_kind`` different windows for each kind and for none; needs text.

    Without any window nothing is learned, and the model adds nothing.
    """
    pieces = docs.select("text").mapInArrow(
        _sample_windows, "piece string, kind string, spans array<struct<start:bigint,kind:bigint,end:bigint>>")
    first = Window.partitionBy("kind").orderBy(F.xxhash64("piece"), "piece")
    chosen = pieces.distinct().withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_kind)
    rows = sorted(stored(chosen, "windows").collect(), key=lambda r: (r.kind, r.place))
    samples = []
    for turn, row in enumerate(rows):
        spans = [(s.start, s.kind, s.end) for s in row.spans]
        samples.append((row.piece, spans))
        if spans:
            samples.append(_replaced(row.piece, spans, disguised, turn))
            samples.append((_replaced(row.piece, spans, decoy, turn)[0], []))
    return train(samples, epochs)


def _replaced(text: str, spans: Sequence[tuple[int, int, int]], by, turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with other forms in place of its spans, and where those are."""
    out, moved, done = "", [], 0
    for start, kind, end in spans:
        form = by(text[start:end], kind, turn)
        out += text[done:start]
        moved.append((len(out), kind, len(out) + len(form)))
        out, done = out + form, end
    return out + text[done:], moved


# ------------------------------------------------------------------ whole texts

def find_spans(text: str, model: Model) -> list[tuple[int, int, int, bool]]:
    """(start, number of the kind, end, whether a base span), in order."""
    if not _CORE.search(text):
        return []
    base = base_spans(text)
    found = {span: True for span in base}
    starts = [s[0] for s in base]
    longest = max((end - start for start, _, end in base), default=0)
    for first, last, opens, closes in pieces(text):
        near = base[np.searchsorted(starts, first - longest):np.searchsorted(starts, last)]
        for segment in model.decode(Lattice(text, first, last, near)):
            span = segment.start, segment.kind - 1, segment.end
            # part of a base span, or the whole around it, says nothing new
            if opens <= span[0] < closes and not any(s < span[2] and span[0] < e for s, _, e in near):
                found[span] = False
    return sorted((*span, is_base) for span, is_base in found.items())


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and spans (kind, start, end, base) per row of ``docs``; needs doc_id and text.

    Spans come by start, then by kind as listed, in code points with the end exclusive; ``base`` tells what the base rules
    find, which the model's own never overlap. Null and empty texts have none; rows that repeat, or have no id,
    come out each; equal texts have equal spans; an empty table gives no rows; other columns take no part,
    whatever their names. Texts are read whole, whatever their length, window by window.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": KINDS[kind], "start": start, "end": end, "base": base}
                      for start, kind, end, base in find_spans(text or "", held.value)]
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, spans {_SPANS_SQL}")


def summary(found: DataFrame) -> DataFrame:
    """Counts of the kinds, a digest of the base spans, and all spans as text, per row of ``scan``."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
