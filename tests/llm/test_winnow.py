from __future__ import annotations

import hashlib
import random
import re

from texts import SYLLABLES, prose, table

from reviewloom.llm import winnow


def words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    passages = [(i, w[at : at + m]) for i, t in items for w in [words(t)] if w for m in [min(10, len(w))] for at in range(len(w) - m + 1)]
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for i, p in passages:
            for at in range(len(w) - len(p) + 1):
                if w[at : at + len(p)] == p:
                    hit.update(range(at, at + len(p)))
                    found.add(i)
        names = ",".join(sorted(str(i) for i in found if i is not None))
        n = len([i for i in found if i is not None])
        out.append((doc_id, len(w), len(hit), n, hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def planted(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(2)
    word = lambda: "".join(SYLLABLES[int(d)] for d in str(rng.randrange(1000, 1040)))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 5, 9, 10, 11, 40])))) for i in range(30)]
    items += [(7, "the the the the the the the the the the the the"), (8, ""), (9, None), (None, "Nameless, item!"), (11, "wörd"), (12, items[3][1])]
    docs = [r for r in rows if len(r[1] or "") < 5000]
    for n in range(40):
        w = items[n % 30][1].split()
        low = rng.randrange(len(w))
        part = w[low : low + rng.randrange(1, 30)]
        docs.append((1000 + n, " ".join([f"d{n}"] * 3 + part) + " " + prose(rng, 80 * (n % 3)) + ", NAMELESS item " * (n % 2) + " the" * (n % 25), None, None))
    return docs, items


def test_same_hits_as_brute_force(spark, awkward_rows):
    docs, items = planted(awkward_rows)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, size int")
    got = sorted(map(tuple, winnow.decontaminate(table(spark, docs), benchmark).collect()), key=repr)
    assert got == sorted(brute(docs, items), key=repr)


def test_empty_tables(spark, awkward, nothing):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(nothing, benchmark).collect() == []
    assert {r["contaminated"] for r in winnow.decontaminate(awkward, benchmark).collect()} == {False}


def test_stays_in_the_engine(awkward, spark, capsys):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    winnow.decontaminate(awkward, benchmark).explain()
    assert "Python" not in capsys.readouterr().out
