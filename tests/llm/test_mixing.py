from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st

from reviewloom.llm import mixing


def targets(totals: dict) -> dict:
    """Share, cap, and share the excess again, until none is above: exact."""
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + ([None] if None in totals else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed: dict = {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = Fraction(sum(totals.values()) - sum(fixed.values()))
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * totals[s]]
        if not above:
            return {**{s: float(v) for s, v in fixed.items()}, **{s: float(v) for s, v in share.items()}}
        fixed.update({s: 3 * totals[s] for s in above})


def size(text: str | None) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_sizes_and_budgets(awkward, awkward_rows):
    got = mixing.mix_sources(awkward).collect()
    totals: dict = defaultdict(int)
    for _, text, _, source in awkward_rows:
        totals[source] += size(text)
    want = targets(totals)
    assert len(got) == len(awkward_rows)
    source = {r[0]: r[3] for r in awkward_rows if r[0] is not None}
    taken: dict = defaultdict(int)
    for row in got:
        assert 0 <= row["taken"] <= 3 * row["size"]
        assert row["size"] == 0 or row["taken"] % row["size"] == 0
        if row["doc_id"] is not None:
            s = source[row["doc_id"]]
            assert row["source_size"] == totals[s]
            assert abs(row["target"] - want[s]) <= 1e-9 * max(1, want[s])
            taken[s] += row["taken"]
    for s in ("s2", "s3"):  # ordinary lengths: met to a word or so
        assert abs(taken[s] - want[s]) <= max(5, 0.05 * want[s])


def test_reruns_agree(awkward):
    runs = [sorted(map(repr, mixing.mix_sources(awkward).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_large_groups_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 50)
    docs = spark.range(3000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 3 = 0, 'x', 'y') as source")
    got = mixing.mix_sources(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert {r[0]: (round(r[1], 6), r[2]) for r in got} == {3000: (round(9000 * 5 / 7, 6), 6429), 6000: (round(9000 * 2 / 7, 6), 2571)}


def test_rows_that_differ_in_one_column_are_used_apart(spark):
    rows = [(1, "a b c", "en", "x"), (1, "a b c", "de", "x"), (1, "a b c", None, "x"), (None, "a b c", None, "x"), (None, "d e f", "", "x")]
    rows += [(2, "g h", "en", "y"), (2, "g h", "en", "y"), (3, "", "en", "y"), (4, None, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    used = sum(r["taken"] // r["size"] for r in mixing.mix_sources(docs).collect() if r["size"])
    out = [tuple(r) for r in mixing.mixed_rows(docs).collect()]
    assert len(out) == used and set(out) <= set(rows)
    alone = mixing.mixed_rows(docs.where("source = 'x'"))  # one source is met by one pass
    assert sorted(map(repr, map(tuple, alone.collect()))) == sorted(repr(r) for r in rows if r[3] == "x")


def test_ties_are_settled(spark):
    """Of many rows without an id the same ones are taken in every run, however they are dealt out."""
    rows = [(None, f"w{i} x y", None, "a" if i % 5 else "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    runs = [sorted(tuple(map(repr, r)) for r in mixing.mixed_rows(docs.repartition(n)).collect()) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) > 0


def test_empty_table(nothing):
    assert mixing.mix_sources(nothing).collect() == []
    assert mixing.mixed_rows(nothing).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 4), max_size=6), st.integers(0, 120))
def test_knapsack_is_the_best_sum(have, budget):
    sizes, free = np.array(sorted(have), np.int64), np.array([have[s] for s in sorted(have)], np.int64)
    sums = {0}
    for s, n in zip(sizes.tolist(), free.tolist()):
        sums = {a + s * k for a in sums for k in range(n + 1)}
    taken = mixing.knapsack(sizes, free, budget)
    assert (taken <= free).all()
    assert (taken * sizes).sum() == max(a for a in sums if a <= budget)
