"""Small tables with every awkward row: nulls, empty and long texts, ties, copies, clashing columns."""

from __future__ import annotations

import random

import pytest
from texts import prose, table


@pytest.fixture(scope="session")
def awkward_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([1, 3, 12, 80, 200])), "xx", f"s{i % 4}") for i in range(40)]
    base = prose(rng, 150)
    words = base.split()
    for i in range(8):  # near copies: a few words changed
        changed = list(words)
        for _ in range(i):
            changed[rng.randrange(len(changed))] = f"new{rng.random()}"
        rows.append((100 + i, " ".join(changed), "xx", "s1"))
    rows += [(200 + i, rows[20][1], None, None) for i in range(6)]  # copies
    rows += [
        (300, None, None, None),
        (301, "", "xx", "s2"),
        (302, " \n\t ", None, "s2"),
        (303, "one", "xx", "é"),
        (304, "One", "xx", "\U0001f600"),
        (305, "a b c", None, ""),
        (306, prose(rng, 30_000), "xx", "s0"),
        (307, "x" * 200_000, "xx", "s0"),
        (308, "the the the the the the", "xx", "s0"),
        (309, "日本語 テキスト 한국어 ١٢٣ <|endoftext|> <s>", "ja", "s3"),
        (310, "same line\nsame line\n\n \nsame line\n", "xx", "s3"),
        (None, "text without an id", "xx", "s1"),
        (None, None, None, None),
        (-5, base, "xx", "s1"),
        (310, "same line\nsame line\n\n \nsame line\n", "xx", "s3"),  # a repeated row
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return table(spark, awkward_rows).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("1 = 0")
