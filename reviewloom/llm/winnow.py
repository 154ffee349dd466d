"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is cut into ``gram``-word hashes; of each run of ``size - gram + 1`` of them the
least is a fingerprint. Two texts that share ``size`` words in a row share the run and
therefore the fingerprint, so a join on fingerprints finds every place worth comparing,
with about a quarter of the hashes. Hits are then extended: the words of each run that
chose a shared fingerprint are compared in full with the benchmark's passages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reviewloom.llm.common import ascii_lower
from reviewloom.staging import settle

# Fixed value: everything in ASCII but digits and lower-case letters parts words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE, GRAM = 10, 5


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null has none."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), lambda w: w != "")


def _grams(hashes: Column, k: int) -> Column:
    """Hash of the k words from each position."""
    whole = F.slice(hashes, 1, F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
    return F.transform(whole, lambda x, i: F.xxhash64(F.lit(k), x, *(F.get(hashes, i + j) for j in range(1, k))))


def _least(grams: Column, width: int) -> Column:
    """The least of ``width`` neighbours from each position."""
    whole = F.slice(grams, 1, F.greatest(F.size(grams) - (width - 1), F.lit(0)))
    return F.transform(whole, lambda x, i: F.least(x, *(F.get(grams, i + j) for j in range(1, width))))


def _with_least(rows: DataFrame, gram: int) -> DataFrame:
    """Adds the fingerprint chosen by each passage, column ``least``.

    Every step reads its input array several times, so Spark keeps the steps apart and
    computes each array once per row.
    """
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", _grams(F.col("hashes"), gram))
    return grams.withColumn("least", _least(F.col("grams"), SIZE - gram + 1))


def _turns(least: Column) -> Column:
    """Where each run of neighbouring passages with one fingerprint begins."""
    turns = F.transform(least, lambda x, i: F.when((i == 0) | (x != F.get(least, i - 1)), i))
    return F.filter(turns, lambda i: i.isNotNull())


def benchmark_passages(benchmark: DataFrame) -> DataFrame:
    """Every passage of every item: (size, passage, item_id); ten words, or a shorter whole item."""
    items = benchmark.select(F.col("item_id"), words_of(F.col("text").cast("string")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(SIZE)))
    start = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("start")
    rows = items.select("item_id", "size", "words", start)
    passage = F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("passage")
    return rows.select("size", passage, "item_id").distinct()


def _prints(passages: DataFrame, gram: int) -> DataFrame:
    """Distinct fingerprints of the passages: (size, print)."""
    rows = passages.select("size", F.split("passage", " ").alias("words")).distinct()
    long = _with_least(rows.where(F.col("size") == SIZE), gram).select("size", F.get("least", F.lit(0)).alias("print"))
    short = rows.where(F.col("size") < SIZE).select("size", _whole_hash("words").alias("print"))
    return long.unionByName(short).distinct()


def _whole_hash(words: str) -> Column:
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.xxhash64(F.lit(0), hashes)


def row_keys() -> list[Column]:
    """Two hashes that tell rows apart by id and text."""
    return [F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"), F.xxhash64(F.lit(2), "text", "doc_id").alias("k2")]


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", *row_keys(), words_of(F.col("text")).alias("words"))


def shared_passages(docs: DataFrame, passages: DataFrame, gram: int = GRAM) -> DataFrame:
    """Every place of a text that holds a passage: (k1, k2, size, at, passage), each once.

    The row keys are those of :func:`row_keys`; ``passages`` is a settled table of
    :func:`benchmark_passages`.
    """
    keyed = _keyed(docs)
    prints = settle(_prints(passages, gram), "prints")
    chosen = _with_least(keyed.where(F.size("words") >= SIZE), gram)
    chosen = chosen.select("k1", "k2", "words", F.size("least").alias("n"), "least", _turns(F.col("least")).alias("turns"))
    run = F.transform(
        "turns",
        lambda first, j: F.struct(
            F.get("least", first).alias("print"),
            first.alias("first"),
            F.coalesce(F.get("turns", j + 1), F.col("n")).alias("stop"),
        ),
    )
    places = chosen.select("k1", "k2", "words", F.lit(SIZE).alias("size"), F.inline(run))
    short = [r[0] for r in passages.where(F.col("size") < SIZE).select("size").distinct().collect()]  # nine at most
    for size in short:
        each = keyed.where(F.size("words") >= size)
        windows = F.transform(
            F.sequence(F.lit(1), F.size("words") - (size - 1)),
            lambda i: F.struct(
                _whole_hash(F.slice("words", i, size)).alias("print"), (i - 1).alias("first"), i.alias("stop")
            ),
        )
        places = places.unionByName(each.select("k1", "k2", "words", F.lit(size).alias("size"), F.inline(windows)))
    # Each place takes along the words of its passages, so that no text is read twice. Where
    # the fingerprints of the benchmark are small enough to broadcast, Spark puts these words
    # together only after a fingerprint has matched.
    span = F.array_join(F.slice("words", F.col("first") + 1, F.col("stop") - F.col("first") + F.col("size") - 1), " ")
    places = places.select("k1", "k2", "size", "print", "first", (F.col("stop") - F.col("first")).alias("n"), span.alias("span"))
    near = places.join(prints, ["size", "print"], "left_semi")
    found = near.select("k1", "k2", "size", "first", F.split("span", " ").alias("words"), F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    passage = F.array_join(F.slice("words", "i", F.col("size")), " ").alias("passage")
    hits = found.select("k1", "k2", "size", (F.col("first") + F.col("i") - 1).alias("at"), passage)
    hits = hits.join(passages.select("size", "passage").distinct(), ["size", "passage"], "left_semi").distinct()
    return settle(hits, "hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM) -> DataFrame:
    """Words of each text that lie in a passage of the benchmark: one row per input row.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Null and empty
    texts have no words and no hits; a null item_id counts for hits but is not listed.
    Rows may share a doc_id or have none: they are told apart by id and text. Equal rows
    get equal results. Empty tables give an empty result or no hits. Other columns are
    ignored.
    """
    passages = settle(benchmark_passages(benchmark), "passages")
    hits = shared_passages(docs, passages, gram)

    before = W.partitionBy("k1", "k2").orderBy("at", "size").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("at") + F.col("size")).over(before), F.lit(0))
    end = F.col("at") + F.col("size")
    covered = hits.select("k1", "k2", F.greatest(end - F.greatest(F.col("at"), reached), F.lit(0)).alias("fresh"))
    counts = covered.groupBy("k1", "k2").agg(F.sum("fresh").alias("n_hit"))
    listed = hits.select("k1", "k2", "size", "passage").distinct().join(passages, ["size", "passage"])
    listed = listed.groupBy("k1", "k2").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = settle(counts.join(listed, ["k1", "k2"]), "found")

    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        _keyed(docs).select("doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words"))
        .join(found, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that share no passage with the benchmark, all columns as they are."""
    passages = settle(benchmark_passages(benchmark), "passages")
    found = shared_passages(docs, passages, gram).select("k1", "k2").distinct().toDF("__k1", "__k2")
    first, second = row_keys()
    return docs.join(found, (first == found["__k1"]) & (second == found["__k2"]), "left_anti")
