import hashlib
import math
from collections import Counter

import numpy as np

from emberline.llm import digest


def level(window):
    entropy = -sum(c / 64 * math.log2(c / 64) for c in Counter(window).values())
    return int(np.rint(entropy / 6 * digest.LEVELS))


def brute_ranks(texts):
    windows = Counter(level(t[i:i + 64]) for t in texts for i in range(len(t) - 63))
    order = sorted(range(digest.LEVELS + 1), key=lambda v: (windows[v], v))
    return np.array([order.index(v) for v in range(digest.LEVELS + 1)], np.int32)


def brute_features(text, ranks):
    """Windows with 16 votes of the 64 that slide over them, half-covered ends included."""
    if 0 < len(text) < 64:
        return [text]
    if not text:
        return []
    keys = [(int(ranks[v]), i) if v >= digest.LOWEST else (digest.LEVELS + 1, i)
            for i, v in enumerate(level(text[i:i + 64]) for i in range(len(text) - 63))]
    votes = Counter()
    for start in range(-63, len(keys)):
        rank, i = min(keys[max(start, 0):start + 64])
        if rank <= digest.LEVELS:
            votes[i] += 1
    return [text[i:i + 64] for i in sorted(votes) if votes[i] >= 16] or [text]


def brute_filters(windows):
    out, seen = [], set()
    for window in windows:
        if len(window) == 64:
            v = np.frombuffer(window, np.uint64)
            h = digest.mix((digest.mix(v) * digest._PLACE[:8]).sum(dtype=np.uint64)[None])
        else:
            h = np.frombuffer(hashlib.blake2b(window, digest_size=8).digest(), np.uint64)
        h = int(h[0])
        if h in seen:
            continue
        if len(seen) % digest.FILTER_FEATURES == 0:
            out.append(np.zeros(digest.FILTER_BITS, np.uint8))
        seen.add(h)
        for i in range(digest.HASHES):
            out[-1][(h >> 11 * i) % digest.FILTER_BITS] = 1
    return np.packbits(np.array(out, np.uint8).reshape(-1, digest.FILTER_BITS), axis=1)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in (r[1] or "")] + [1]))
    texts = [r[1] or "" for r in rows]
    ranks = brute_ranks([t.encode() for t in texts])
    out = []
    for i, (doc, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(rows)]
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        a, b, c = (brute_filters(brute_features(t.encode(), ranks)) for t in (text, new, after))
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), digest.written(a), digest.written(b),
                    digest.likeness(a, b), digest.likeness(a, c)))
    return out


def test_matches_brute_force(make, documents):
    texts = [r.text for r in documents.orderBy("n_chars").limit(45).collect()[::3]]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, "short"), (None, "é𝄞 " * 70), (103, texts[5]),
                                     (103, texts[6]), (104, texts[5]), (105, "a" * 500), (106, "ab" * 32)]
    docs = make(rows).repartition(5)
    got = sorted(map(tuple, digest.fingerprints(docs).collect()), key=str)
    assert got == sorted(expected(rows), key=str)
    assert got == sorted(map(tuple, digest.fingerprints(docs.coalesce(1)).collect()), key=str)


def test_small_tables(make):
    assert digest.fingerprints(make([])).count() == 0
    one = digest.fingerprints(make([(1, "x" * 30 + "some more text to fill a window, and then a little more of it")]))
    assert one.collect()[0].near_next == 1.0


def test_likeness_falls_with_edits(documents):
    text = max((r.text for r in documents.collect()), key=len).encode()[:12_000]
    other = bytes(reversed(text))
    ranks = np.arange(digest.LEVELS + 1, dtype=np.int32)

    def like(changed):
        a, b = (digest.filters(h) for h in digest.features([text, changed], ranks))
        return digest.likeness(a, b)

    scores = [like(text[:cut] + other[cut:]) for cut in (12_000, 11_000, 8_000, 3_000, 0)]
    assert scores[0] == 1.0 and scores == sorted(scores, reverse=True) and scores[1] > 0.6 and scores[-1] < 0.15


def test_fingerprints_read_back():
    chain = digest.filters(digest.features([bytes(range(256)) * 9], np.arange(1001, dtype=np.int32))[0])
    assert (digest.read(digest.written(chain)) == chain).all() and digest.read("").shape == (0, 256)


def test_constant_texts_differ(make):
    texts = ["a" * 500, "-" * 500, "", "a" * 500, "-" * 501]
    got = {r.doc_id: r for r in digest.fingerprints(make(list(enumerate(texts)))).collect()}
    prints = [got[i].fingerprint for i in range(5)]
    assert prints[0] == prints[3] and len({*prints}) == 4 and prints[2] == ""
    assert got[1].near_next < 0.5 and got[2].near_next < 0.5 and got[4].near_next < 0.5
