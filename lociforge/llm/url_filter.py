"""URL filtering by host and path rules, with membership from a cascade of Bloom filters.

Level 1 encodes the listed keys; level 2 the universe's false positives of level 1; level 3 the listed keys that
level 2 takes by mistake; and so on until a level has none.  As the levels are built against the *complete* universe of
keys that the corpus can ask about, an answer is exact for every key of that corpus and needs no join: a few bits are
tested per key.  Keys stay in tables and the levels are filled by aggregations, so a list of millions is no different from one of five.
A list too long for the plan (``MAX_LISTED``) is looked up by an equi-join instead, with the same results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociforge.llm import bits
from lociforge.llm.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Listed keys whose first level fits the plan.
MAX_LISTED = 8_000_000


@dataclass(frozen=True)
class Rule:
    """``action`` (allow or block) for a host, all its subdomains, and paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where the host is."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class BloomCascade:
    """Exact membership of the column ``key`` of ``listed`` among that of ``universe``.

    The first level's false-positive rate is (listed / universe), so the false positives number about as many as the listed keys, whatever
    the corpus's size; later levels only halve.  Null keys are never listed.  An empty list gives a cascade that says no, an empty universe
    level 1 alone.  Only the levels' bits come to the driver.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame):
        asked = universe.select("key").where("key is not null")
        right = materialize(listed.select("key").where("key is not null").distinct(), "listed-keys")
        self.levels: list[bits.BitTable] = []
        n = right.count()
        if not n:
            return
        size = asked.agg(F.approx_count_distinct("key")).first()[0] or 1
        per_key = min(16.0, max(2.0, math.log2(max(2.0, size / n)) * 1.44))
        first = bits.fill(right, math.ceil(n * per_key), max(1, round(per_key * math.log(2))))
        wrong = materialize(asked.where(first.hit(F.col("key"))).distinct().join(right, "key", "left_anti"), "listed-wrong")
        self.levels.append(first)
        while n := wrong.count():  # wrong: what this level must tell from right
            level = bits.fill(wrong, n * 6 + 64, 3, len(self.levels) + 1)
            self.levels.append(level)
            right, wrong = wrong, materialize(right.where(level.hit(F.col("key"))), "listed-wrong")

    def contains(self, key: Column) -> Column:
        """Whether ``key`` is listed: the first level that refuses it decides, by that level's parity."""
        said = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            said = F.when(self.levels[i].hit(key), said).otherwise(F.lit(i % 2 == 1))
        return F.coalesce(said & key.isNotNull(), F.lit(False))


def rule_table(spark: SparkSession, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """(action, host, path, key) of the rules."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.action, r.host, r.path) for r in rules], "action string, host string, path string")
    known = rules.select("action", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    return known.withColumn("key", F.concat("host", "path"))


def candidate_keys(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Every key under which a rule of these label counts and path lengths could fit, as an array."""
    parts = F.split(host, r"\.")
    counts = F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= F.size(parts))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    suffix = lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    return F.flatten(F.transform(counts, lambda n: F.transform(starts, lambda p: F.concat(suffix(n), F.substring(path, F.lit(1), p)))))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to ``pages``.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest key wins, of equally long ones
    the last in code point order, and of equal keys a block.  ``rule`` is the key (null: none fits) and ``verdict`` its action.  Without a rule the cascades decide: a key that none of them lists is not
    on the blocklist, so ``default`` holds.  Null or malformed urls have an empty host and path and get the default; repeated rows stay.
    Columns of ``pages`` named host, path, rule or verdict are replaced.  ``rules`` may be a table (action, host, path) of any length.
    """
    read = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    listed = materialize(rule_table(pages.sparkSession, rules), "url-rules")
    shapes = listed.agg(F.collect_set(F.size(F.split("host", r"\."))), F.collect_set(F.length("path")), F.count("*")).first()  # label counts and path lengths, a few each
    keys = candidate_keys(F.col("host"), F.col("path"), sorted(shapes[0]), sorted(shapes[1]))
    if not shapes[2]:
        return read.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    if shapes[2] > MAX_LISTED:
        return _by_join(read, listed, keys, default)
    universe = read.select(F.explode(keys).alias("key"))
    cascades = {a: BloomCascade(listed.where(F.col("action") == a), universe) for a in ("block", "allow")}
    fits = F.filter(keys, lambda k: cascades["block"].contains(k) | cascades["allow"].contains(k))
    by_length = F.sort_array(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))), asc=False)
    read = read.withColumn("rule", F.get(by_length, 0)["k"])
    verdict = F.when(F.col("rule").isNull(), default).when(cascades["block"].contains(F.col("rule")), "block").otherwise("allow")
    return read.withColumn("verdict", verdict)


def _by_join(read: DataFrame, listed: DataFrame, keys: Column, default: str) -> DataFrame:
    """The same verdicts by an equi-join of the rows' keys with the rules; rows are numbered in a written table."""
    rows = materialize(read.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    asked = rows.select("_row", F.explode(keys).alias("key"))
    best = F.max(F.struct(F.length("key").alias("n"), F.col("key").alias("k"), (F.col("action") == "block").alias("b")))
    found = asked.join(listed.select("key", "action"), "key").groupBy("_row").agg(best.alias("_x"))
    verdict = F.when(F.col("_x").isNull(), default).when(F.col("_x.b"), "block").otherwise("allow")
    kept = [F.col(f"`{c}`") for c in read.columns if c not in ("rule", "verdict")]
    return rows.drop("rule", "verdict").join(found, "_row", "left").select(*kept, F.col("_x.k").alias("rule"), verdict.alias("verdict"))
