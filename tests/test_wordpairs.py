from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import embedding, spectra, wordpairs
from reviewloom.staging import settle, shared_folder

COLUMNS = spectra.column_names("x", 3)


def texts(n=60, length=700, vocabulary=90, seed=4):
    """Texts longer than a stretch; words are unequally frequent and now and then repeat at once."""
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, vocabulary + 1)
    name = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    return [" ".join(name(i) for i in rng.choice(vocabulary, size, p=share / share.sum())) for size in rng.integers(0, length, n)]


def counted(spark, lists, window, min_count):
    tokens = embedding.listed_words(spark.createDataFrame([(t,) for t in lists], "text string").repartition(5), "text")
    totals, code = embedding.word_totals(tokens, window)
    often = totals.where(F.col("n") >= min_count).select("word", "code")
    return wordpairs.count_pairs(tokens, code, often, window, 1_000)


def unpacked(matrix):
    word = {r.key: r.word for r in matrix.words.collect()}
    out = {}
    for row in matrix.tiles.where("not sums").collect():
        one, two = divmod(row.tile, matrix.side)
        for offset, n in zip(*wordpairs.unpack(row.data)):
            pair = tuple(sorted((word[one * matrix.width + offset // matrix.width], word[two * matrix.width + offset % matrix.width])))
            assert pair not in out
            out[pair] = int(n)
    return out


def test_packed_pairs_come_back():
    offsets = np.array([0, 1, 70_000, 2**32 - 1])
    counts = np.array([1, 2**40, 3, 300])
    back = wordpairs.unpack(wordpairs.pack(offsets, counts))
    assert (back[0] == offsets).all() and (back[1] == counts).all()


@pytest.mark.parametrize("block, held", [(1 << 15, 4_000_000), (7, 500)])
def test_every_pair_is_counted_once_in_one_tile(spark, monkeypatch, block, held):
    monkeypatch.setattr(wordpairs, "BLOCK", block)
    monkeypatch.setattr(wordpairs, "HELD", held)
    lists = [*texts(), None, "", "solo", "red red red"]
    want: dict = {}
    total: dict = {}
    for text in lists:
        words = (text or "").split()
        for i, a in enumerate(words):
            for b in words[i + 1 : i + 4]:
                pair = tuple(sorted((a, b)))
                want[pair] = want.get(pair, 0) + 1
                for x in pair:
                    total[x] = total.get(x, 0) + 1
    want = {pair: n for pair, n in want.items() if all(total[x] >= 40 for x in pair)}
    matrix = counted(spark, lists, 3, 40)
    assert unpacked(matrix) == want and any(a == b for a, b in want)
    assert matrix.side == (1 if block > 7 else -(-matrix.words.count() // 7))
    assert matrix.total == 2 * sum(want.values())


@pytest.mark.parametrize("block", [1 << 15, 7])
def test_products_are_those_of_the_table_of_information(spark, monkeypatch, block):
    monkeypatch.setattr(wordpairs, "BLOCK", block)
    lists = texts(20)
    matrix = counted(spark, lists, 2, 30)
    pairs, names = embedding.coded_pair_counts(spark.createDataFrame([(t,) for t in lists], "text string"), window=2, min_count=30)
    table = embedding.named(embedding.mutual_information(pairs, 1), names)
    drawn = settle(spectra.random_columns(matrix.words, COLUMNS, 1, "word"))
    plain = drawn.join(matrix.words, "key").select(F.col("word").alias("key"), *COLUMNS)
    # rows that are not given are not met
    for some in (F.lit(True), F.xxhash64("word") % 2 == 0):
        kept = matrix.words.where(some)
        got = matrix.times(drawn.join(kept, "key", "left_semi"), COLUMNS).join(matrix.words, "key")
        got = {r.word: [r[c] for c in COLUMNS] for r in got.collect()}
        rows = spectra.product(table, plain.join(kept.select(F.col("word").alias("key")), "key", "left_semi"), COLUMNS)
        want = {r.key: [r[c] for c in COLUMNS] for r in rows.collect()}
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)


def vectors(reviews, **how):
    return {r.category: r.vector for r in embedding.category_word_vectors(reviews, **how).collect()}


def test_more_words_than_a_task_holds_give_the_same_vectors(spark, monkeypatch):
    rows = [(("a", "b", None)[i % 3], t) for i, t in enumerate(texts(30, 300))]
    reviews = spark.createDataFrame([*rows, ("none", None)], "category string, text string")
    one = vectors(reviews, dims=3, window=2, min_count=20)
    monkeypatch.setattr(embedding, "KNOWN", -1)
    two = vectors(reviews, dims=3, window=2, min_count=20)
    assert set(one) == set(two) == {"a", "b", None, "none"} and one["none"] is two["none"] is None
    for x in ("a", "b", None):
        assert np.abs(one[x]) == pytest.approx(np.abs(two[x]), abs=1e-6)


def test_no_known_words(spark):
    reviews = spark.createDataFrame([("a", "red car"), ("b", ""), (None, None)], "category string, text string")
    assert vectors(reviews, dims=2, window=2, min_count=50) == {"a": None, "b": None, None: None}


def shuffled(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle"))


def folder_bytes(spark) -> int:
    top = shared_folder(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(f"{top}/reviewloom/{spark.sparkContext.applicationId}") for name in names)


def test_disk_holds_each_pair_in_a_few_bytes(spark):
    rng = np.random.default_rng(9)
    name = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    rows = [("c", " ".join(name(i) for i in rng.integers(0, 600, 400))) for _ in range(300)]
    reviews = spark.createDataFrame(rows, "category string, text string").repartition(4)
    before = shuffled(spark) + folder_bytes(spark)
    embedding.category_word_vectors(reviews, dims=2, window=5, min_count=50)
    assert shuffled(spark) + folder_bytes(spark) - before < 5_000_000  # 600,000 neighbours, 174,000 different pairs


def test_compact_tables_leave_no_shuffle_files(spark):
    before = shuffled(spark)
    rows = spark.range(100_000).select((F.col("id") * 7 % 50_000).alias("a"), "id").groupBy("a").agg(F.sum("id").alias("n"))
    table = settle(rows, compact=True)
    assert shuffled(spark) <= before and table.count() == 50_000 and table.agg(F.sum("n")).first()[0] == 100_000 * 99_999 // 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
