import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import packing
from emberline.llm.queries import VOCABULARY
from emberline.llm.text import chunks


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCABULARY)


def check(rows, tokenizer, texts, window=2048):
    ids = {doc: tokenizer.encode(text or "", add_special_tokens=False).ids + [1] for doc, text in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        piece = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert (r.length, r.doc_tokens) == (len(piece), len(ids[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(piece.tobytes())
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        end = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == end
            end += r.length
        assert end == len(ids[doc])
    for pieces in by_sequence.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= window and end & (end - 1) == 0


def test_documents(documents, tokenizer):
    texts = {r.doc_id: r.text for r in documents.collect()}
    check(packing.pack(documents.repartition(3), VOCABULARY).collect(), tokenizer, texts)
    check(packing.pack(documents, VOCABULARY, open_windows=4).collect(), tokenizer, texts)


def test_awkward_texts(make, tokenizer):
    texts = {1: None, 2: "", 3: " \t ", 4: "a\x1cb c d <|endoftext|>x<|startoftext|>", 5: "it's WE'LL 123é́",
             6: "x" * 5000, 7: "long words here " * 4000, 8: "ΣΑΣ ς \x85q"}
    check(packing.pack(make(list(texts.items())), VOCABULARY).collect(), tokenizer, texts)
    assert packing.pack(make([]), VOCABULARY).count() == 0
    again = packing.pack(make([(1, "a b"), (1, "a b"), (None, "c")]), VOCABULARY).collect()
    assert sum(r.length for r in again if r.doc_id == 1) == 6 and sum(r.length for r in again) == 8


@given(st.text(alphabet=st.sampled_from(list("aZé \t\n\x0b\x1c\x85 'sS12!|<>é́ß")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_never_join(text):
    from tokenizers import Tokenizer
    if "t" not in _cache:
        _cache["t"] = Tokenizer.from_file(VOCABULARY)
        _cache["w"] = packing.Vocabulary(open(VOCABULARY, encoding="utf-8").read())
    chunk, = chunks(pa.array([text, None, text]))
    ids, bounds = _cache["w"].ids(chunk)
    expected = _cache["t"].encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expected * 2 and bounds.tolist() == [0, len(expected), len(expected), 2 * len(expected)]


_cache: dict = {}


def test_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    levels = packing.Levels(16)
    for _ in range(500):
        size = int(rng.integers(1, 16))
        level = levels.choose(size)

        def squares(h):
            n = levels.count.copy()
            if h:
                n[h] -= 1
            if h + size < 16:
                n[h + size] += 1
            return int((n[1:16] ** 2).sum())

        allowed = [h for h in range(0, 17 - size) if h == 0 or levels.count[h]]
        assert squares(level) == min(map(squares, allowed))
        levels.place((0, 0, np.zeros(size, np.uint32), size))
