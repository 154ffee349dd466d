"""The registered queries over the smallest tables: against SQL, and with the promised columns."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import compare  # noqa: E402
from reviewloom.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_mixing": "doc_id size source_size target taken",
    "op4_fertility": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_crossparse": "doc_id held_out lang_pred score",
    "op9_rans": "doc_id start n_tokens ids_crc32",
    "op13_density": "page_id url text n_chars",
    "op10_recurrent": "doc_id held_out n_tokens n_known train_tokens base_score score",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("no benchmark tables here")
    if name in ORACLE_SQL:
        verdict, _, _ = compare.compare(spark, compare.oracle(FOLDER), name, FOLDER)
        assert verdict.startswith("ok (")
    else:
        df = QUERIES[name](spark, FOLDER)
        assert set(COLUMNS[name].split()) <= set(df.columns)
        table = "pages" if "page_id" in df.columns else "documents"
        assert df.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
