import hashlib
import math
import random
import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import personal

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def brute_base(text):
    found = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.span()))
    found += [("phone", m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [f"{k}:{s}:{e}" for k, (s, e) in sorted(found, key=lambda f: (f[1][0], KINDS.index(f[0])))]


def labels(text):
    return [f"{personal.KINDS[kind]}:{start}:{end}" for start, kind, end in personal.base_spans(text)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.1 2+5(-)0é%", max_size=60))
def test_base_spans_of_random_texts(text):
    assert labels(text) == brute_base(text)


TEXTS = [
    None, "", "plain words", "a@b.c@d.e x@y z@w.v. .@a.b", "mail é.x_y%z+1-2@mail-7.example.com!", "1.2.3.4.5.6.7.8 256.1.1.1 00001.02.3.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "7536784127813050 4845168114407329",
    "+1 (017) 555-7713 +12 +1 (826) 555-4081 190.137.223.204", "+4111111111111111 +1.2.3.4.5.6.7.8.9", "x" * 3_000 + "@a.b",
    "@" * 500 + "a@b.c", "9" * 4_000 + ".1.1.1", "+1" + " " * 3_000 + "2", "1-" * 2_000, "١٢٣@example.com a@é.com",
    "w " * 60_000 + "end@mail.example.com", "line\nbreak 1.1.1.1\n4111 1111\n1111 1111",
]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    words = "the of meeting report number call write order pay from host and was in it".split()
    samples = []
    for turn in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        kind = turn % 4
        span = (f"{rng.choice(words)}.{digits[:2]}@mail{digits[3]}.example.com",
                ".".join(str(rng.randrange(256)) for _ in range(4)),
                digits + next(d for d in "0123456789" if luhn(digits + d)), f"+1 ({digits[:3]}) 555-{digits[3:7]}")[kind]
        left, right = " ".join(rng.choices(words, k=6)) + " ", " " + " ".join(rng.choices(words, k=6))
        text, spans = left + span + right, [(len(left), kind, len(left) + len(span))]
        samples += [(text, spans), personal._replaced(text, spans, personal.disguised, turn),
                    (personal._replaced(text, spans, personal.decoy, turn)[0], [])]
    return personal.train(samples)


def test_base_spans_stay(make, model):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(8, TEXTS[8]), (8, TEXTS[8]), (None, TEXTS[8]), (None, None)]
    got = personal.summary(personal.scan(make(rows), model)).collect()
    assert len(got) == len(rows)
    expected = sorted((i is not None, i, hashlib.sha256(",".join(brute_base(t or "")).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id, r.base_sha256) for r in got) == expected
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(TEXTS):
        spans = by_id[i].spans.split(",") if by_id[i].spans else []
        assert set(brute_base(text or "")) <= set(spans) and len(spans) == len(set(spans))
        starts = [(int(s.split(":")[1]), KINDS.index(s.split(":")[0])) for s in spans]
        assert starts == sorted(starts)
        assert [sum(s.startswith(k) for s in spans) for k in KINDS] == [by_id[i][f"n_{k}"] for k in KINDS]


def added(text, model):
    return [(personal.KINDS[kind], text[start:end]) for start, kind, end, base in personal.find_spans(text, model) if not base]


def test_model_adds_what_the_rules_miss(model):
    assert added(TEXTS[7], model) == [("card", "7536784127813050"), ("card", "4845168114407329")]
    assert added("call (017) 555-7713 it was", model) == [("phone", "(017) 555-7713")]
    assert added("write order.17 [at] mail3 [dot] example [dot] com of the", model) == [
        ("email", "order.17 [at] mail3 [dot] example [dot] com")]
    assert added("from 10[.]20[.]30[.]40 and", model) == [("ip", "10[.]20[.]30[.]40")]
    assert added("+1 (826) 555-4081 190.137.223.204 of", model) == [("phone", "+1 (826) 555-4081")]


@pytest.mark.parametrize("text", [
    "on 2024-05-06 it was 1,234,567", "Apache License, Version 2.0.", "token 04dbebab91ab85687d33eeaaf9ac699e and",
    "look at home. The dot is", "pay 4111  1111  1111  1112 of", "the 12 of 345 was 6789", "@home and at dot", ""])
def test_model_leaves_the_rest_alone(text, model):
    assert added(text, model) == []


def segmentations(first, last, segments):
    """All ways through an island, as lists of segments; atoms outside are not listed."""
    if first == last:
        yield []
        return
    for rest in segmentations(first + 1, last, segments):
        yield rest
    for segment in segments:
        if segment.first == first:
            for rest in segmentations(segment.last, last, segments):
                yield [segment, *rest]


def labelled(first, last, path):
    """Scores of a path's pairs: its labels in order, one per outside atom and one per segment."""
    at, out = first, [0]
    for segment in path:
        out += [0] * (segment.first - at) + [segment.kind]
        at = segment.last
    return out + [0] * (last - at) + [0]


def total(model, first, last, path):
    pairs, order = model.pairs(), labelled(first, last, path)
    return sum(pairs[a][b] for a, b in zip(order, order[1:])) + sum(model.score(s) for s in path)


CROWDED = ["a 1 22-333 444 (555) 12 x", "5.6.7.8 9 +1 234 567 89", "b.c [at] d.e [dot] f 1234567 7654321"]


@pytest.mark.parametrize("text", CROWDED)
def test_decoding_and_slopes_against_all_segmentations(text, model):
    rng = random.Random(text)
    lattice = personal.Lattice(text, 0, len(text))
    own = personal.Model({f: rng.gauss(0.3, 1) for s in lattice.segments for f in s.features}
                         | {f"pair {a} {b}": rng.gauss(0, 1) for a, b in product(range(5), range(5))})
    decoded = own.decode(lattice)
    for first, last, segments in personal.islands(lattice):
        paths = list(segmentations(first, last, segments))
        scores = [total(own, first, last, p) for p in paths]
        mine = [s for s in decoded if first <= s.first < last]
        assert total(own, first, last, sorted(mine, key=lambda s: s.first)) == pytest.approx(max(scores))
        gold = rng.choice([p for p in paths if p])
        places = {(s.first, s.last, s.kind) for s in gold}
        likelihood, slope = personal.gradient(own, first, last, segments, places)
        whole = math.log(sum(math.exp(s - max(scores)) for s in scores)) + max(scores)
        assert likelihood == pytest.approx(total(own, first, last, gold) - whole)
        for f in rng.sample(sorted(slope), min(12, len(slope))):
            ends = []
            for step in (1e-5, -1e-5):
                moved = personal.Model({**own.weights, f: own.weights.get(f, 0.0) + step})
                ends.append(personal.gradient(moved, first, last, segments, places)[0])
            assert slope[f] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-4)


def test_long_windows_are_searched_whole(model, monkeypatch):
    text = "7 " * 9_000 + "call (017) 555-7713 it " + "8 x " * 6_000 + "from 10[.]20[.]30[.]40 and" + " 9" * 9_000
    assert added(text, model) == [("phone", "(017) 555-7713"), ("ip", "10[.]20[.]30[.]40")]
    places = [p for p in personal.pieces(text)]
    assert len(places) > 2 and [p[2] for p in places[1:]] == [p[3] for p in places[:-1]]


def test_fit_learns_from_documents(spark, documents):
    own = personal.fit(documents)
    assert added("call (017) 555-7713 it was", own) == [("phone", "(017) 555-7713")]
    again = personal.fit(documents.repartition(5))
    assert own.weights == again.weights
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in personal.summary(personal.scan(documents, own)).collect()}
    for i, text in rows:
        assert set(brute_base(text or "")) <= set(got[i].spans.split(",") if got[i].spans else [])
        assert got[i].base_sha256 == hashlib.sha256(",".join(brute_base(text or "")).encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark, make):
    own = personal.fit(make([]))
    assert own.weights == {} and personal.summary(personal.scan(make([]), own)).count() == 0
    rows = spark.createDataFrame([(1, "x@y.z", "s", "k", 1, 2, "p")],
                                 "doc_id bigint, text string, spans string, kind string, start int, base int, piece string")
    assert personal.summary(personal.scan(rows, personal.fit(rows))).first().spans == "email:0:5"
