"""Views of the benchmark tables in the shape of the review contracts.

Each adapter is a projection (at most one equi-join), so filters and column pruning
still reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.contracts import ARTICLE_SECTIONS


def table(spark: SparkSession, folder: str, name: str, heavy: bool = False) -> DataFrame:
    """One benchmark table. Its files hold one row group each; ``heavy`` deals the rows out
    to as many tasks as a shuffle has, for costly work on each of them."""
    scan = spark.read.parquet(f"{folder}/{name}.parquet")
    return scan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if heavy else scan


def text_reviews(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """Documents as reviews, for work on texts."""
    part = F.col("doc_id") % 10
    return table(spark, folder, "documents", heavy).select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("source") == "src0", "Unknown").otherwise(F.col("lang")).alias("category"),
        F.concat(F.lit("P"), (F.col("doc_id") % 40).cast("string")).alias("asin"),
        (F.length("text") % 6).cast("double").alias("rating"),
        (F.col("n_chars") % 50).alias("helpful_vote"),
        "text",
        F.when(part == 0, "test").when(part == 1, "val").otherwise("train").alias("split"),
    )


def page_reviews(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """Web pages as reviews whose text still has markup."""
    return table(spark, folder, "pages", heavy).select(
        F.col("page_id").alias("review_id"), F.col("html").alias("text"), F.col("page_id").cast("string").alias("asin")
    )


def ranked_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as reviews of parts, for work on products."""
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")

    shipped = F.unix_date(F.col("l_shipdate").cast("date"))
    row = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped.cast("string"))
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        row.alias("review_id"),
        F.when(F.col("p_type") == "ECONOMY", "[UNKNOWN]").otherwise(F.col("p_type")).alias("category"),
        F.col("l_partkey").alias("asin"),
        (F.col("p_size") % 5).alias("meta_category"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("double").alias("rating"),
        (F.floor("l_extendedprice").cast("bigint") % 100).alias("helpful_vote"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string"), F.lit(" line "), F.col("l_linenumber").cast("string"),
                 F.lit(" "), "l_returnflag", "l_linestatus").alias("text"),
    )


def category_points(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as categories with a cluster (-1 is noise) and a probability."""
    vector = F.col("embedding").cast("array<double>")
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("cat"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("category"),
        vector.alias("vector"),
        F.when(vector[0] < -0.15, -1).otherwise(F.col("label") % 7).alias("cluster"),
        F.round(F.least(F.lit(1.0), F.abs(vector[1]) * 6), 4).alias("probability"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Document labels as three classes, with a prediction that is wrong at times."""
    both = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id"), "doc_id")
    label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    named = both.select(F.col("doc_id").alias("id"), label.alias("label"))
    wrong = F.col("id") % 5 == 0
    guess = F.when(wrong, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    share = [F.when(F.col("prediction") == c, 0.8).otherwise(0.1) for c in range(3)]
    return named.withColumn("prediction", guess).withColumn("probability", F.array(*share))


def articles(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """A user turn as source and the assistant's next turn as generated article."""
    turns = table(spark, folder, "conversations", heavy)
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("asked"))
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    conv = F.col("conv_id")

    def numbered(prefix: str, n: int):
        return F.concat(F.lit(prefix), (conv % n).cast("string"))

    sections = [
        F.when((conv + s) % 4 != 0, F.lit(title + (" as follows" if s % 2 else "") + "\n")).otherwise("")
        for s, title in enumerate(ARTICLE_SECTIONS)
    ]
    item = F.concat(numbered("1. Item ", 3), F.lit(" Key Strengths: solid\n"))
    extra = F.concat(F.lit("• Extra "), F.col("turn").cast("string"), F.lit(" Key Strengths: light\n"))
    shared = F.concat(numbered("Product: P", 7), F.lit("\n"))
    other = F.concat(numbered("Product: P", 5), F.lit("\n"))
    return user.join(reply, ["conv_id", "turn"]).select(
        F.concat_ws("-", conv.cast("string"), F.col("turn").cast("string")).alias("article_id"),
        (conv % 5).cast("int").alias("meta_category"),
        F.concat(*sections, item, shared, other, extra, F.col("answer")).alias("generated"),
        F.concat(shared, item, F.col("asked")).alias("source"),
    )
