from reviewloom.functions.formats import one_decimal, percent, thousands
from reviewloom.functions.hashing import hash_bucket, order_digest
from reviewloom.functions.text import (
    count_words,
    extract_products,
    header_lines,
    normalize_text,
    product_title,
    redact_text,
    required_sections,
    strip_space,
    words,
)
from reviewloom.functions.tokens import encode_tokens

__all__ = [
    "count_words",
    "encode_tokens",
    "extract_products",
    "hash_bucket",
    "header_lines",
    "normalize_text",
    "one_decimal",
    "order_digest",
    "percent",
    "product_title",
    "redact_text",
    "required_sections",
    "strip_space",
    "thousands",
    "words",
]
