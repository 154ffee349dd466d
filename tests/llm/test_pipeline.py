"""The whole pipeline on a small folder, stage by stage against the plain definitions."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from texts import table  # noqa: E402
from test_fertility import counts  # noqa: E402
from test_minhash import groups  # noqa: E402
from test_rans import whole_text_ids  # noqa: E402
from test_winnow import brute, planted  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, awkward_rows, tmp_path_factory):
    docs, items = planted(awkward_rows)
    where = tmp_path_factory.mktemp("tables")
    table(spark, docs).write.parquet(f"{where}/documents.parquet")
    items = [(i, t) for i, t in items if t is None or len(t.split()) >= 5]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where), docs, items


def test_stages(spark, folder):
    where, docs, items = folder
    steps = dict(corpus_pipeline.STAGES)
    df = spark.read.parquet(f"{where}/documents.parquet")
    columns = df.columns
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]

    def after(name: str) -> list[tuple]:
        nonlocal df
        df = steps[name](spark, df, where)
        assert df.columns == columns
        df = corpus_pipeline.settle(df, name)
        return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]

    good = after("quality")
    assert Counter(good) <= Counter(r for r in rows if not counts(r[1])["base_failed"])
    assert len(good) > 20

    kept = after("near_duplicates")
    root = groups(good, 5, 80)
    assert Counter(kept) == Counter({r for r in good if r[0] is not None and root[r[0]] == r[0]}) + Counter(
        r for r in good if r[0] is None
    )

    clean = after("decontamination")
    bad = [r[-1] for r in brute(kept, items)]
    assert Counter(clean) == Counter(r for r, b in zip(kept, bad) if not b) and any(bad)

    mixed = after("mixing")
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 3

    tokens = steps["token_files"](spark, df, where).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in tokens] == sorted(
        ((r[0], len(whole_text_ids(r[1]))) for r in mixed), key=lambda r: (r[0] is not None, r[0])
    )


def test_run_is_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0
