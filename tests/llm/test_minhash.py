from __future__ import annotations

from itertools import combinations

import pytest

from reviewloom.llm import minhash


def groups(rows: list[tuple], k: int, percent: int) -> dict[int, int]:
    """Component of each id by comparing all sets with all."""
    sets: dict[int, list[frozenset]] = {}
    for i, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
        sets.setdefault(i, []).append(frozenset(grams))
    root = {i: i for i in sets if i is not None}
    for a, b in combinations(sorted(root), 2):
        linked = any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
        if linked and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return root


@pytest.mark.parametrize("k", [4, 5])
def test_same_groups_as_brute_force(awkward, awkward_rows, k):
    got = minhash.near_duplicates(awkward, minhash.MinHash(shingle=k)).collect()
    want = groups(awkward_rows, k, 80)
    assert len(got) == len(awkward_rows)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == want[row["doc_id"]]
            assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_sizes_and_empty_texts(awkward):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(awkward, minhash.MinHash(shingle=4)).collect()}
    assert [got[i]["n_shingles"] for i in (300, 301, 302, 303, 305, 308)] == [0, 0, 0, 1, 1, 1]
    assert got[301]["component_id"] == 301 and got[302]["component_id"] == 302
    assert got[304]["component_id"] == 303  # "One" and "one"


def test_empty_table(nothing):
    assert minhash.near_duplicates(nothing).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5), (3, 2)]
    found = minhash.components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {r["id"]: r["root"] for r in found}
    assert root == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}}
