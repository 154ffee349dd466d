"""From raw reviews to cleaned, labelled splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewloom.functions.text import computed_once, redact_text
from reviewloom.operators.quality import (
    clean_raw,
    dedup_reviews,
    drop_empty_processed,
    preprocess_dataset,
    relabel_unknown,
    sentiment_label,
    valid_reviews,
)
from reviewloom.operators.sampling import sample_per_category, stratified_split
from reviewloom.staging import settle


def clean_split(df: DataFrame) -> DataFrame:
    """Cleaning of already split reviews; copies are dropped inside each split."""
    kept = relabel_unknown(dedup_reviews(clean_raw(df)))
    masked = computed_once(kept, "processed_text", redact_text(F.col("text")))
    return sentiment_label(drop_empty_processed(masked))


def prepare(
    reviews: DataFrame,
    variant: str = "redacted",
    frac: float | None = 0.03,
    test: float = 0.1,
    val: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Sample, filter, clean and split in the order of the chosen recipe.

    ``normalized``: sample, keep valid ratings, normalize the text, drop short
    texts, then split. ``redacted``: sample, keep valid ratings, split, then clean
    inside each split and add the sentiment. ``frac=None`` keeps all rows.

    The rows to split are written once: the split looks at their ids several times,
    which would otherwise repeat the text work.
    """
    if variant not in ("normalized", "redacted"):
        raise ValueError(f"unknown variant: {variant}")
    rounding = "half_even" if variant == "normalized" else "floor"
    sampled = reviews if frac is None else sample_per_category(reviews, frac, seed, rounding=rounding)
    valid = valid_reviews(sampled)
    if variant == "normalized":
        return stratified_split(settle(preprocess_dataset(valid), "cleaned"), test, val, seed)
    return clean_split(stratified_split(settle(valid, "valid"), test, val, seed))
