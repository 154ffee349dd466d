from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from reviewloom.llm import laesa

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, ints string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", -1, "x") for r in rows], SCHEMA).repartition(3)


def plain(rows, parts=8, entries=16, rounds=6):
    """One row at a time, every entry compared."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    long = max(len(r[1]) for r in kept)
    width = max(1, -(-long // parts))
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))
    book = [[cut[i][p] for i in order[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, p: min((gap(x, c), e) for e, c in enumerate(book[p]))
    for _ in range(rounds):
        who = [[near(v[p], p)[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for e in range(len(book[p])):
                own = [v[p] for v, w in zip(cut, who) if w[p] == e]
                if own:
                    book[p][e] = [sum(column) // len(own) for column in zip(*own)]
    out, labels = [], {}
    for r, v in zip(kept, cut):
        best = [near(v[p], p) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), r[2]))
        labels[r[2]] = labels.get(r[2], 0) + out[-1][2]
    flat = ",".join(str(x) for part in book for c in part for x in c)
    return sorted(((i, code, error, labels[label], hashlib.sha256(flat.encode()).hexdigest()) for i, code, error, label in out), key=repr)


def got(spark, rows):
    return sorted(map(tuple, laesa.vector_codes(table(spark, rows)).collect()), key=repr)


def sample(n=60, d=16, seed=3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(scale=0.3, size=d)], [None, 1, 1, 2][i % 4]) for i in rng.permutation(n)]


def test_against_plain(spark):
    rows = sample()
    assert got(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = sample(30)
    rows += [
        (100, None, 1), (101, [], 1), (102, [1.0, None] + [0.0] * 14, 1), (103, [float("nan")] * 16, None), (104, [float("inf")] * 16, 2),
        (105, [0.5], 7), (106, [0.25] * 13, None), (None, [0.1] * 16, None), (3, rows[0][1], 1), (3, rows[0][1], 1), (107, [-0.0] * 16, 1),
    ]
    rows += [(200 + i, [0.2] * 16, 9) for i in range(40)]  # copies
    assert got(spark, rows) == plain(rows)


def test_fewer_vectors_than_entries(spark):
    rows = sample(5)
    assert got(spark, rows) == plain(rows)


def test_no_usable_vector(spark):
    assert got(spark, [(1, None, 1)]) == [] == got(spark, [])
    assert laesa.vector_codes(table(spark, [])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_huge_components_are_bounded(spark):
    rows = [(i, [1e30 * (-1) ** i] * 16, 0) for i in range(4)]
    out = got(spark, rows)
    assert len(out) == 4 and all(r[2] >= 0 for r in out)


@pytest.mark.parametrize("pivots", [1, 4, 8])
def test_pivots_prune_and_lose_nothing(pivots):
    rng = np.random.default_rng(pivots)
    part = np.concatenate([rng.integers(-300, 300, (500, 4)) + 3000 * rng.integers(0, 4, (500, 1)), np.zeros((20, 4), np.int64)])
    entries = np.concatenate([part[:14], part[:1], part[3:4]])  # two entries are copies: ties go to the lower index
    chosen = laesa.choose_pivots(entries[None], pivots)[0]
    who, best, made = laesa.nearest(
        part, np.sqrt(laesa.squared(part, chosen)), entries, np.sqrt(laesa.squared(chosen, entries))
    )
    full = laesa.squared(part, entries)
    assert (who == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert made < 0.6 * full.size


def test_frequent_labels_are_split_off(spark):
    rows = [(i, i % 3 if i % 3 else i, 5) for i in range(3000)] + [(9000 + i, None, 7) for i in range(10)]
    coded = spark.createDataFrame([(i, label, "", error) for i, label, error in rows], "vec_id long, label int, code string, error long")
    out = {r.vec_id: r.label_error for r in laesa.with_label_errors(coded).collect()}
    sums: dict = {}
    for _, label, error in rows:
        sums[label] = sums.get(label, 0) + error
    assert out == {i: sums[label] for i, label, _ in rows}
