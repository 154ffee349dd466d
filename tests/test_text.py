from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reviewloom import functions as fn


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("t"))).collect()]


def without_tags(text):
    """Markup replaced by a space, found by walking from bracket to bracket."""
    out, at = "", 0
    while at < len(text):
        end = text.find(">", at + 1) if text[at] == "<" else -1
        if end > at + 1:
            out, at = out + " ", end + 1
        else:
            out, at = out + text[at], at + 1
    return out


def cut_link(word, starts):
    """The part of a word before its first link start that something follows."""
    spots = [i for i in range(len(word)) for s in starts if word.startswith(s, i) and len(word) > i + len(s)]
    return (word[: min(spots)], True) if spots else (word, False)


def plain_normalize(text):
    kept = []
    for word in without_tags(text.lower()).split():
        word, _ = cut_link(word, ("http", "www"))
        if "@" not in word[1:-1]:
            kept.append("".join(c if c.isascii() and c.isalpha() else " " for c in word))
    return " ".join(" ".join(kept).split())


def mask_mail(word):
    def part(c):
        return c.isalnum() or c in "_.-"

    out, at = "", 0
    while (sign := word.find("@", at)) >= 0:
        left, right = sign, sign + 1
        while left > at and part(word[left - 1]):
            left -= 1
        while right < len(word) and part(word[right]):
            right += 1
        if left < sign and right > sign + 1:
            out, at = out + word[at:left] + "[EMAIL]", right
        else:
            out, at = out + word[at : sign + 1], sign + 1
    return out + word[at:]


def plain_redact(text):
    out = []
    for word in without_tags(text).split():
        word, linked = cut_link(word, ("http://", "https://"))
        out.append(mask_mail(word + "[URL]" if linked else word))
    return " ".join(out)


SAMPLES = [
    "<b>Great</b> phone!!! see http://a.b/c?d=1 now",
    "awww.nice stuff, write to Me.You@x.org; thanks",
    "a@ @b @@ @@@ x@@y a@b@c",
    "link http://x\u00a0after no-break",
    "tabs\tand\x1cseparators\x85here\u2003wide",
    "<<a> b> <> < no end",
    "http",
    "  ",
    "",
    "Ünïcode É 123 ½ x.y-z@ü.de",
]


def test_normalize_agrees_with_plain_python(spark):
    assert column(spark, SAMPLES, fn.normalize_text) == [plain_normalize(s) for s in SAMPLES]


def test_redact_agrees_with_plain_python(spark):
    assert column(spark, SAMPLES, fn.redact_text) == [plain_redact(s) for s in SAMPLES]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB<>@.w/:htp \t\n\u00a0é-_1", max_size=40), min_size=20, max_size=60))
def test_cleaning_on_random_text(spark, texts):
    assert column(spark, texts, fn.normalize_text) == [plain_normalize(s) for s in texts]
    assert column(spark, texts, fn.redact_text) == [plain_redact(s) for s in texts]


def test_null_text(spark):
    assert column(spark, [None], fn.normalize_text) == [None]
    with pytest.raises(Exception, match="text must be a string"):
        column(spark, [None], lambda c: fn.normalize_text(c, strict=True))


def test_product_title(spark):
    pages = [
        '<html><span id="productTitle" class="x"> Phone &amp; Case </span><h1 id="title">Other</h1></html>',
        '<h1 class="a" id="title"><b>Only</b> heading</h1>',
        '<span id="productTitle">  </span>',
        '<span data-id="productTitle">No</span>',
        None,
    ]
    got = column(spark, pages, lambda c: fn.product_title(c, F.lit("B1")))
    assert got == ["Phone & Case", "Only heading", "Product B1", "Product B1", "Product B1"]


def test_extract_products_finds_all_three_forms(spark):
    text = "\n    1. Product A Key Strengths: Good\n    Product: Product B\n    • Product C Key Strengths: Nice\n"
    (got,) = column(spark, [text], fn.extract_products)
    assert sorted(got) == ["Product A", "Product B", "Product C"]


def plain_products(text):
    forms = (r"(?i)\d\.\s*([^.]+?)\s*(?=key strengths:)", r"(?i)product:\s*(.+)", r"(?i)•\s*([^.]+?)\s*(?=key strengths:)")
    return {name.strip() for form in forms for name in re.findall(form, text)}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["1.", " Key Strengths:", "Product:", "•", " A", "b ", "\n", ".", "key strengths:"]), max_size=12).map("".join), min_size=20, max_size=40))
def test_extract_products_on_random_text(spark, texts):
    got = column(spark, texts, fn.extract_products)
    assert [set(g) for g in got] == [plain_products(t) for t in texts]


def test_sections_and_headers(spark):
    text = "title: x\nIntroduction:\nTOP 3 recommended products:\n a:\nb: \nFinal Verdict: y"
    assert column(spark, [text], fn.required_sections) == [
        ["Title:", "Introduction:", "TOP 3 RECOMMENDED PRODUCTS:", "Final Verdict:"]
    ]
    assert column(spark, [text, ""], fn.header_lines) == [3, 0]


def test_encode_tokens_cuts_and_pads(spark):
    ids, mask = fn.encode_tokens(F.col("t"), max_len=4, vocab=100)
    df = spark.createDataFrame([("a b",), ("a b c d e f",), ("",)], "t string")
    rows = df.select(ids.alias("ids"), mask.alias("mask")).collect()
    assert [r.mask for r in rows] == [[1, 1, 0, 0], [1, 1, 1, 1], [0, 0, 0, 0]]
    assert rows[0].ids[:2] == rows[1].ids[:2] and rows[0].ids[2:] == [0, 0]
    assert all(1 <= i <= 100 for i in rows[1].ids)


def test_formats(spark):
    df = spark.range(1)
    row = df.select(
        fn.one_decimal(F.lit(4.25)), fn.one_decimal(F.lit(4.05)), fn.thousands(F.lit(1234567)), fn.percent(F.lit(0.125), 1)
    ).first()
    assert tuple(row) == ("4.3", "4.1", "1,234,567", "12.5%")
