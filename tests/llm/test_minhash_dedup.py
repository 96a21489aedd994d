"""Links that miss their hub and the hubs of the groups outside it."""

import numpy as np
import pytest

from chartlift.llm import minhash_dedup


def words(name, n):
    return [f"{name}{i}" for i in range(n)]


@pytest.mark.parametrize("small", [1, 16])
def test_links_behind_several_hubs(spark, monkeypatch, small):
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    # 4 and 5 are linked. What they share outside hub 1 is all in 2, what they share outside 2 is all in 3.
    a, b, c, rest = words("a", 40), words("b", 40), words("c", 40), words("r", 240)
    texts = {
        1: a + b[:4] + rest, 2: b + c + rest, 3: a + b[:20] + rest,
        4: a + b + c + words("x", 8), 5: a + b + c + words("y", 8),
    }
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bands = {1: [1, 2, 3], 2: [1, 2, 3], 3: [1, 2], 4: [1], 5: [1]}  # 1 is the heaviest, then 2, then 3
    unique = spark.createDataFrame([*bands.items()], "doc_id long, bands array<long>")
    assert sorted(tuple(r) for r in minhash_dedup.link(unique, docs).collect()) == [(3, 1), (5, 4)]


def test_parities_never_claim_more_than_the_sets_differ():
    from chartlift.llm.minhash_dedup import MARKS, parities

    rng = np.random.default_rng(5)
    for size, changed in ((0, 0), (1, 1), (40, 3), (300, 300), (5000, 900)):
        common = rng.integers(0, 2**63, size).astype(np.uint64)
        more = rng.integers(0, 2**63, changed).astype(np.uint64)
        first, second = parities(common), parities(np.concatenate([common, more]))
        apart = sum(int(x).bit_count() for x in (first ^ second).view(np.uint64))
        assert len(first) * 64 == MARKS and apart <= changed
        assert changed < 10 or apart > min(changed, MARKS) / 4


def test_groups_are_searched_for_added_members_that_sizes_allow(spark):
    def found(added, small, *more):
        members = [(2, 5, 2, False, [7]), (3, 1, 3, added, [7]), *more]
        families = spark.createDataFrame(
            [(u, weight, component, 10, 0, new, outside, 1, [0] * 16) for u, weight, component, new, outside in members],
            "u long, weight long, component long, n_u long, joint long, added boolean, outside array<long>, v long, marks array<long>")
        return sorted(tuple(r) for r in minhash_dedup._shared_outside(families, small).select("u", "v", "deep").collect())

    assert found(False, 64) == [] and found(False, 0) == []
    assert found(True, 64) == [(3, 2, False)] and found(True, 0) == [(3, 2, True)]
    late = (4, 1, 4, True, [1, 2, 3, 7])  # shares 7 of 10 shingles at most from there on, and no link of 10 and 10 needs fewer than 9
    assert found(True, 64, late) == [(3, 2, False)] and found(True, 0, late) == [(3, 2, True)]


@pytest.mark.parametrize("chunk", [2, 4096])
def test_common_shingles_are_kept_as_far_as_a_link_may_begin(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash_dedup, "CHUNK", chunk)
    common = [11, 12, 13, 14, 15, 16, 17]
    members = [  # 22 shingles each, 12 of them in the hub: a link needs 5 outside it
        (2, 2, [-1, -2, *common, 21]), (3, 3, [-3, *common, 22, 23]),
        (4, 4, [31, 32, 33, 34, 35, 36, *common[:4]]),  # has 4 in common with others
        (5, 2, [-1, -2, *common, 41]),  # -1 and -2 are in one component only
        (5, 2, [-1, -2, *common[1:], 42, 43]),  # another text of the same id
    ]
    families = spark.createDataFrame(
        [(u, 1, component, 22, 12, True, outside, 1, [0] * 16) for u, component, outside in members],
        "u long, weight long, component long, n_u long, joint long, added boolean, outside array<long>, v long, marks array<long>")
    kept = minhash_dedup._common(families)
    rows = sorted((r.u, r.left, len(r.outside)) for r in kept.collect())
    assert rows == [(2, 7, 3), (3, 7, 3), (5, 6, 2), (5, 7, 3)]
    assert all(set(r.outside) <= set(common) for r in kept.collect())
    pairs = {tuple(r) for r in minhash_dedup._shared_outside(kept, 64, "left").select("u", "v").collect()}
    assert pairs == {(3, 2), (5, 3)}


def test_groups_with_the_same_members_are_joined_once(spark):
    families = spark.createDataFrame(
        [(u, 1, u, 40, 20, True, outside, 1, [0] * 16) for u, outside in ((2, list(range(11))), (3, list(range(11))), (4, [50]))],
        "u long, weight long, component long, n_u long, joint long, added boolean, outside array<long>, v long, marks array<long>")
    large = minhash_dedup._shared_outside(families, 0)
    assert [tuple(r) for r in large.collect()] == [(3, 2, True)]
    # The other groups of 2 and 3 do not reach the join.
    assert minhash_dedup._groups(minhash_dedup._keyed(families, "n_u - joint")).count() == 1


def test_many_copies_of_one_text_take_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "SMALL", 4)
    monkeypatch.setattr(minhash_dedup, "LARGEST", 4, raising=False)
    families, rounds = minhash_dedup._families, []

    def counted(*frames):
        rounds.append(1)
        assert len(rounds) <= 5
        return families(*frames)

    monkeypatch.setattr(minhash_dedup, "_families", counted)
    rng = np.random.default_rng(3)
    edits = {i: dict.fromkeys(rng.choice(40, 5, replace=False) * 5, f"w{i}") for i in range(1, 41)}  # linked with no other
    edits |= {i: {place: f"w{i}"} for i, place in ((50, 20), (51, 120))}  # what they share is in all the others
    edits |= {i: {**dict.fromkeys(range(3, 60, 7), "rare"), 199: f"w{i}"} for i in (60, 61)}  # what they share is in no other
    texts = {i: [own.get(place, f"base{place}") for place in range(200)] for i, own in edits.items()}
    sets = {i: {tuple(t[k : k + 5]) for k in range(196)} for i, t in texts.items()}
    linked = [(a, b) for a in sets for b in sets if a > b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert {(51, 50), (61, 60)} <= set(linked)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bands = spark.createDataFrame([(i, list(range(max(1, 50 - i)))) for i in texts], "doc_id long, bands array<long>")
    component = {i: i for i in texts}
    for _ in texts:
        for a, b in linked:
            component[a] = component[b] = min(component[a], component[b])
    found = sorted(tuple(r) for r in minhash_dedup.link(bands, docs).collect())
    assert found == [(i, c) for i, c in component.items() if i != c]
