"""Fixed-length token ids built from hashed words."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reviewloom.functions.hashing import hash_bucket
from reviewloom.functions.text import first_words


def encode_tokens(text: Column, max_len: int = 256, vocab: int = 50_000) -> tuple[Column, Column]:
    """``(input_ids, attention_mask)``, both cut and padded to ``max_len``.

    Ids start at 1; 0 is padding. Words past ``max_len`` are cut before hashing,
    as the fixed input width of a sequence model requires.
    """
    kept = first_words(text, max_len)
    ids = F.transform(kept, lambda w: hash_bucket(w, vocab) + F.lit(1))
    used = F.size(kept)
    pad = F.array_repeat(F.lit(0).cast("bigint"), F.lit(max_len) - used)
    mask = F.concat(F.array_repeat(F.lit(1).cast("bigint"), used), pad)
    return F.concat(ids, pad), mask
