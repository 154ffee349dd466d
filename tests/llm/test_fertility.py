from __future__ import annotations

import math
import random
import re
from collections import Counter

import sentencepiece

from reviewloom.llm import fertility, wordids

PATH = wordids.vocabulary("piece_bpe_32k.model")


def counts(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = [i for w in words for i in model.encode(w)]
    share = [n / len(ids) for n in Counter(ids).values()]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": failed,
        "n_tokens": len(ids),
        "n_byte_tokens": sum(model.is_byte(i) for i in ids),
        "entropy": -sum(p * math.log2(p) for p in share),
    }


def test_counts_of_every_text(awkward, awkward_rows):
    got = fertility.fertility(awkward, PATH).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_words"])
    want = sorted(({"doc_id": r[0], **counts(r[1])} for r in awkward_rows), key=key)
    assert len(got) == len(want)
    for have, expected in zip(sorted(got, key=key), want):
        have = have.asDict()
        assert abs(have.pop("entropy") - expected.pop("entropy")) < 1e-6
        assert {k: have[k] for k in expected} == expected
        assert not (have["kept"] and have["base_failed"])


def test_bands_reject(spark):
    nouns = "river mountain town winter garden letter market engine window table bridge harbour".split()
    rng = random.Random(1)
    prose = " ".join(f"{rng.choice(nouns)} {rng.randrange(100)} {rng.choice(nouns)}" for _ in range(60))
    rows = [(1, prose), (2, "ab " * 10 + " ".join("ሴ" * 3 + chr(0x1200 + i) for i in range(60)))]
    rows += [(3, " ".join(chr(97 + i * i % 23) + chr(97 + i * 7 % 26) for i in range(90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    narrow = {**fertility.BANDS, "latin": (1.6, 6.0, 0.1, 4.0)}
    kept = {r["doc_id"]: r["kept"] for r in fertility.fertility(docs, PATH, narrow).collect()}
    assert kept[1] and not kept[2] and not kept[3]


def test_bands_are_learnt_per_language(spark):
    rng = random.Random(2)
    sounds = {"aa": "ing ter the ate ment con pro ous ist able per dis".split(), "bb": "ung ver ich sch gen ein lich keit heit zu auf mit".split()}
    rows = []
    for i in range(400):
        lang = "ab"[i % 2] * 2
        words = ["".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(150, 200))]
        junk = i % 40 < 2  # marks stuck on words, as many in either language
        rows.append((i, " ".join(w + "#" * junk for w in words), lang, "clash"))
    rows.append((400, rows[0][1].replace("#", ""), "zz", "clash"))  # too few of a language to learn from
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, script string")
    fixed = {r["doc_id"]: r["kept"] for r in fertility.fertility(docs, PATH, fertility.BANDS).collect()}
    assert all(fixed.values())  # the fixed bands reject nothing
    learnt = {r["doc_id"]: r["kept"] for r in fertility.fertility(docs, PATH).collect()}
    assert not any(learnt[i] for i in range(400) if i % 40 < 2) and learnt[400]
    assert sum(learnt[i] for i in range(400) if i % 40 >= 2) > 0.95 * 380
    through = fertility.keep_fertile(docs, PATH)
    assert through.columns == docs.columns
    assert sorted(r["doc_id"] for r in through.collect()) == sorted(i for i in learnt if learnt[i])


def test_empty_table(nothing):
    assert fertility.fertility(nothing, PATH).collect() == []
