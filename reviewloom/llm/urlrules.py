"""URL filters: a fixed rule list, then association rules mined from labels.

Spark's FP-growth finds token sets of addresses that often go with a bad label. Sets with
enough support and confidence become rules, unless a smaller rule says the same. Rules and
addresses meet over an inverted index of tokens. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.llm.common import ascii_lower
from reviewloom.staging import settle

# Host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SUPPORT, PRIOR = 0.01, 10  # least share of labelled pages; doubt


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return ascii_lower(host), path, query


def tokens(host: Column, path: Column, query: Column) -> Column:
    """Host labels, path steps (digits as 0) and query names of an address, each once."""

    def marked(parts: Column, mark: str) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    steps = F.split(F.regexp_replace(path, "[0-9]+", "0"), "/")
    names = F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^[^=]*", 0))
    return F.array_distinct(F.concat(marked(F.split(host, r"\."), "h:"), marked(steps, "p:"), marked(names, "q:")))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest rule that fits, as a struct (length, rule, verdict); null without one."""
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(*fits))


def mined_rules(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, prior: int = PRIOR) -> DataFrame:
    """Rules (rule, n, place, token): token sets that mark bad pages.

    A page is bad where the label row of its id says toxic or low quality. A set of n
    labelled pages, b of them bad, becomes a rule if b reaches ``support`` of all labelled
    pages and b / (n + prior) reaches one half, whatever its size; it is dropped where some of
    its tokens are a rule already.

    Before sets are mined, tokens that are rules by themselves go, and tokens that stand on
    the same labelled pages become one: a smallest rule holds at most one of them, and each
    of them can take that place. Only bad pages are mined; the pages of the sets found there
    are counted over all. A rule has ``n`` places and a row for every token of a place.
    """
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    marked = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad.cast("int")).alias("bad"))
    rows = pages.select("page_id", "tokens").join(marked, "page_id").where((F.size("tokens") > 0) | (F.col("bad") == 1))
    baskets = settle(rows.select(F.monotonically_increasing_id().alias("row"), "bad", F.array_distinct("tokens").alias("tokens")), "baskets")
    count = baskets.count()
    least = max(1, math.ceil(support * count))
    rule = (F.col("b") >= least) & (F.col("b") * 2 >= F.col("n") + prior)

    each = baskets.select("row", "bad", F.explode("tokens").alias("token"))
    place = lambda half: F.sum(F.xxhash64(F.lit(half), "row").cast("decimal(38,0)"))
    seen = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("bad").alias("b"), place(1).alias("p1"), place(2).alias("p2"))
    seen = settle(seen.where(F.col("b") >= least), "tokens")
    alone = seen.where(rule).select(F.array("token").alias("set"))
    alike = seen.where(~rule).groupBy("n", "b", "p1", "p2").agg(F.min("token").alias("item"))
    alike = settle(seen.where(~rule).join(alike, ["n", "b", "p1", "p2"]).select("token", "item", "n"), "alike")

    items = each.join(alike.where("token = item").drop("item"), "token")
    slim = settle(items.groupBy("row", "bad").agg(F.collect_list("token").alias("items")), "items")
    marks = slim.where("bad = 1")
    among = marks.count()
    if among < least:
        rules = alone
    else:
        found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / among)).fit(marks.select("items")).freqItemsets
        sets = settle(found.where(F.size("items") > 1).select(F.array_sort("items").alias("set"), F.col("freq").alias("b")), "itemsets")
        # a set is looked up by its rarest item, then compared in full
        rarest = sets.select("set", F.explode("set").alias("token")).join(alike.select("token", "n"), "token")
        rarest = rarest.groupBy("set").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
        pages_of = slim.select("items", F.explode("items").alias("token")).join(rarest, "token")
        pages_of = pages_of.where(F.size(F.array_except("set", "items")) == 0).groupBy("set").agg(F.count("*").alias("n"))
        rules = _least_sets(sets.join(pages_of, "set").where(rule).select("set")).unionByName(alone)
    named = rules.select(F.array_join("set", "\n").alias("rule"), F.size("set").alias("n"), F.posexplode("set").alias("place", "item"))
    tokens_of = named.join(alike.select("token", F.col("item")), "item", "left")
    return settle(tokens_of.select("rule", "n", "place", F.coalesce("token", "item").alias("token")), "rules")


def _least_sets(sets: DataFrame) -> DataFrame:
    """The token sets (set) that hold no other, found size by size from the smallest."""
    rest = settle(sets.withColumn("n", F.size("set")), "candidates")
    kept = rest.where("1 = 0")
    while (n := rest.agg(F.min("n")).first()[0]) is not None:
        least, larger = rest.where(F.col("n") == n), rest.where(F.col("n") > n)
        kept = kept.unionByName(least)
        part = least.select(F.get("set", F.lit(0)).alias("token"), F.col("set").alias("part"))
        each = larger.select("set", F.explode("set").alias("token"))
        within = (each["token"] == part["token"]) & (F.size(F.array_except("part", "set")) == 0)
        rest = settle(larger.join(each.join(part, within, "left_semi").select("set"), "set", "left_anti"), "candidates")
    return kept.select("set")


def judge_urls(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, prior: int = PRIOR) -> DataFrame:
    """Verdict of every page's url: page_id, host, path, rule, verdict.

    The longest fixed rule decides; without one, a page is blocked if a mined rule fires,
    else allowed. A null url, or one without ``://``, has an empty host and path and is
    allowed unless labels teach otherwise. Pages without an id take part; equal addresses
    get equal verdicts. Other columns are ignored; empty tables give no rules or rows.
    """
    host, path, query = address(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"), query.alias("query"))
    rows = rows.select("page_id", "host", "path", tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"))
    rules = mined_rules(rows, labels, support, prior)
    # The inverted index: a rule fires where a token is found for each of its places.
    kinds = rows.select("tokens").distinct().withColumn("kind", F.xxhash64("tokens"))
    fired = kinds.select("kind", F.explode("tokens").alias("token")).join(rules, "token")
    fired = fired.groupBy("kind", "rule", "n").agg(F.count_distinct("place").alias("found")).where("found = n")
    fired = settle(fired.select("kind").distinct(), "fired").withColumn("fired", F.lit(True))
    judged = rows.withColumn("kind", F.xxhash64("tokens")).join(fired, "kind", "left")
    fixed = fixed_rule(F.col("host"), F.col("path"))
    return judged.withColumn("fixed", fixed).select(
        "page_id",
        "host",
        "path",
        F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", F.when(F.col("fired"), "block").otherwise("allow")).alias("verdict"),
    )
