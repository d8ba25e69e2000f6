import numpy as np
import pandas as pd
import pytest

from emberline.llm import jaccard


def slot(draw, families, each, noise, sets, share):
    """Families of near copies, lone points, and sets that hold most points of a family each."""
    points = []
    for _ in range(families):
        base = draw.integers(0, 6, jaccard.GROUPS)
        points += [np.maximum(base + (draw.random(jaccard.GROUPS) < 0.03) - (draw.random(jaccard.GROUPS) < 0.03), 0) for _ in range(each)]
    points += [draw.integers(0, 6, jaccard.GROUPS) for _ in range(noise)]
    points = np.array(points, np.uint16)[draw.permutation(len(points))]
    cid = np.sort(draw.choice(10_000, len(points), replace=False))
    members = [np.sort(draw.choice(cid, int(share * len(cid)), replace=False)) for _ in range(sets)]
    members += [draw.choice(cid, 5, replace=False) for _ in range(4)]
    table = pd.DataFrame({"cid": cid, "n": points.sum(1, dtype=np.int64), "part": cid, "vector": [jaccard.packed(p) for p in points]})
    return pd.DataFrame({"slot": 3, "members": members}), table


def reaching(met, points):
    """Pairs of points that share a set and reach the bound, one by one."""
    vectors, sizes = jaccard.unpacked(points["vector"].tolist()).astype(int), points["n"].to_numpy()
    at, out = {c: i for i, c in enumerate(points["cid"])}, set()
    for members in met["members"]:
        own = sorted(at[c] for c in members)
        for i in own:
            shared = np.minimum(vectors[i], vectors[own]).sum(1)
            out |= {(i, j) for j, s in zip(own, shared) if i < j and 9 * s >= 4 * (sizes[i] + sizes[j])
                    and 5 * min(sizes[i], sizes[j]) >= 4 * max(sizes[i], sizes[j])}
    return out


@pytest.fixture
def tested(monkeypatch):
    seen, inner = [], jaccard.passing
    monkeypatch.setattr(jaccard, "passing", lambda points, sizes, a, b: (seen.append(len(a)), inner(points, sizes, a, b))[1])
    return seen


@pytest.mark.parametrize("families, each, noise, share", [(3, 30, 60, 0.8), (0, 0, 120, 0.9), (8, 15, 20, 0.3)])
def test_points_with_a_candidate_are_those_of_a_loop(families, each, noise, share):
    met, points = slot(np.random.default_rng(families), families, each, noise, 12, share)
    pairs = reaching(met, points)
    found = jaccard._possible(met, points)
    wanted = points["cid"].to_numpy()[sorted({i for pair in pairs for i in pair})]
    assert set(wanted) <= set(found["cid"]) and (found["slot"] == 3).all()
    if share > 0.5 or not families:
        assert set(found["cid"]) == set(wanted)
    everything = {(min(i, j), max(i, j)) for a, b, _ in jaccard._Slot(met, points).candidates(False) for i, j in zip(a, b)}
    assert pairs <= everything


def test_sets_that_overlap_are_looked_through_once(tested):
    met, points = slot(np.random.default_rng(1), 0, 0, 200, 40, 0.9)
    jaccard._possible(met, points)
    # the nearest pairs come twice; set by set it would be 600,000 and more
    assert sum(tested) < 200 * 200


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(tested):
    met, points = slot(np.random.default_rng(2), 1, 600, 0, 1, 1.0)
    assert len(jaccard._possible(met, points)) == 600
    assert sum(tested) < 600 * 599 / 2 / 8


def test_a_union_is_bounded(monkeypatch):
    met, points = slot(np.random.default_rng(3), 0, 0, 200, 20, 0.6)
    monkeypatch.setattr(jaccard, "TOGETHER", 150)
    large = [np.searchsorted(points["cid"], m) for m in met["members"] if len(m) > 5]
    unions = jaccard._Slot(met, points)._together(large)
    assert 1 < len(unions) <= len(large) and max(map(len, unions)) <= 150
    assert all(any(np.isin(own, union).all() for union in unions) for own in large)
