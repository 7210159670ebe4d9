"""Benchmark decontamination: windows of benchmark words searched in training texts, in DataFrame functions only.

The windows' hashes fill a bit table that travels with the plan (of a bounded size, whatever the benchmark's).  A text's windows are tested
inside its row; the few that pass leave it as words and meet the benchmark's windows in a join that compares the words: a broadcast
hash join where the windows' measured size allows it, else a shuffled one.  Either way every window is compared and every hit is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.llm import bits
from lociforge.llm.storage import materialize
from lociforge.llm.url_filter import LOWER, UPPER

#: Everything but digits, letters a-z and non-ASCII characters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of windows and item lists that may be broadcast.
MAX_BROADCAST = 32 << 20
#: Bits of the table per window, and its probes.
BITS, PROBES = 32, 2


def norm_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, -1), "")


def _hash_at(hashes: Column, start: Column, n: int) -> Column:
    """Of the ``n`` word hashes from the 0-based ``start``."""
    return F.xxhash64(*[F.get(hashes, start + k) for k in range(n)])


@dataclass(frozen=True)
class Benchmark:
    """``grams``: window (its words joined by spaces), n and the items that hold it; ``lengths``: the windows' word counts."""

    grams: DataFrame
    table: bits.BitTable
    lengths: tuple[int, ...]
    size: int

    def joined(self, hits: DataFrame) -> DataFrame:
        """``hits`` (gram, n) with the items of equal windows, null for none."""
        return hits.join(F.broadcast(self.grams) if self.size <= MAX_BROADCAST else self.grams, ["gram", "n"], "left")  # a measured size


def benchmark_windows(benchmark: DataFrame, width: int, item: str = "item_id", text: str = "text") -> Benchmark:
    """All windows of the benchmark.  An item with fewer than ``width`` words, but some, is one window."""
    words = benchmark.select(F.col(item).cast("string").alias("item"), norm_words(F.col(text)).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n)))
    rows = words.select("item", n.alias("n"), gram.alias("g")).select("item", "n", F.array_join("g", " ").alias("gram"))
    grams = materialize(rows.groupBy("gram", "n").agg(F.sort_array(F.collect_set("item")).alias("items")), "benchmark-windows")
    items = F.aggregate("items", F.lit(0), lambda s, x: s + F.octet_length(x) + 24)
    known = grams.agg(F.count("*"), F.sum(F.octet_length("gram") + items + 64), F.sort_array(F.collect_set("n"))).first()  # at most ``width`` lengths
    hashes = grams.select(F.transform(F.split("gram", " "), lambda w: F.xxhash64(w)).alias("h"), "n")
    key = F.lit(0).cast("long")
    for k in known[2]:
        key = F.when(F.col("n") == k, _hash_at(F.col("h"), F.lit(0), k)).otherwise(key)
    return Benchmark(grams, bits.fill(hashes.select(key.alias("key")), known[0] * BITS, PROBES), tuple(known[2]), known[1] or 0)


def find_hits(docs: DataFrame, benchmark: Benchmark, key: str, text: str = "text") -> DataFrame:
    """``docs``' key with n_words and one row per window that passes the table, of which those with ``n`` and ``items`` are hits; or one row without any.

    The windows' hashes stay in one array per text and only those that pass leave it, so rows grow with the hits, not with the words.
    """
    words = docs.select(F.col(key), norm_words(F.col(text)).alias("w"))
    hashed = words.withColumn("h", F.transform("w", lambda w: F.xxhash64(w))).withColumn("n_words", F.size("w").cast("long"))
    if not benchmark.lengths:
        return hashed.select(key, "n_words", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("array<string>").alias("items"))

    def passed(n: int) -> Column:
        starts = F.when(F.size("h") >= n, F.sequence(F.lit(0), F.size("h") - n)).otherwise(F.array().cast("array<int>"))
        gram = lambda i: F.struct(i.alias("start"), F.lit(n).alias("n"), F.array_join(F.slice("w", i + 1, F.lit(n)), " ").alias("gram"))
        return F.transform(F.filter(starts, lambda i: benchmark.table.hit(_hash_at(F.col("h"), i, n))), gram)

    hits = hashed.select(key, "n_words", F.explode_outer(F.concat(*map(passed, benchmark.lengths))).alias("x")).select(key, "n_words", "x.start", "x.n", "x.gram")
    return benchmark.joined(hits).select(key, "n_words", "start", F.when(F.col("items").isNotNull(), F.col("n")).alias("n"), "items")


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted (start, end) spans."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    step = lambda s, x: F.struct(F.greatest(s["upto"], x["end"]).alias("upto"), (s["n"] + F.greatest(x["end"] - F.greatest(s["upto"], x["start"]), F.lit(0))).cast("long").alias("n"))
    return F.aggregate(spans, zero, step, lambda s: s["n"])


def _judged(keyed: DataFrame, windows: Benchmark) -> DataFrame:
    """Per key: n_words, spans, n_hit and items."""
    hits = find_hits(keyed, windows, "key")
    span = F.when(F.col("n").isNotNull(), F.struct("start", (F.col("start") + F.col("n")).alias("end")))
    per = hits.groupBy("key").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(span)).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return per.withColumn("n_hit", _covered(F.col("spans")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, spans (word start, end), items and contaminated.

    A window is ``width`` consecutive words of an item, or the whole of a shorter one; every document word inside an occurrence
    is hit.  Rows are judged one by one: repeated doc_ids stay apart.  Null and empty texts have no words; an empty
    benchmark hits nothing; other columns play no part.  The shuffle carries a row per document or hit, never a text.
    """
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    per = _judged(rows.select(F.struct("doc_id", "row").alias("key"), "text"), benchmark_windows(benchmark, width, item, item_text))
    return per.select(F.col("key.doc_id").alias("doc_id"), "n_words", "n_hit", "spans", "items", (F.col("n_hit") > 0).alias("contaminated"))


def contamination_digest(found: DataFrame) -> DataFrame:
    """The items of each document as a count and a digest."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, max_share: float = 0.0, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows of which more than ``max_share`` of the words are hit; all columns, and rows without words, stay.

    The hit texts are found first, as a table of ids and two hashes of the text; an anti join then drops them, so equal rows share their fate.
    """
    print_of = F.struct(F.col(doc).cast("string").alias("_doc"), F.xxhash64(F.col(text)).alias("_h"), F.xxhash64(F.lit("again"), F.col(text)).alias("_g"))
    hits = _judged(docs.select(print_of.alias("key"), F.col(text).alias("text")), benchmark_windows(benchmark, width))
    gone = materialize(hits.where(F.col("n_hit") > F.lit(max_share) * F.col("n_words")).select("key"), "contaminated")
    mark = gone.select(F.col("key").alias("_key"))
    return docs.join(mark, print_of == F.col("_key"), "left_anti")
