"""Read depth per bin, with repeats masked, and GC content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociforge.functions import cigar
from lociforge.operators.intervals import bins, covered_by_bin, union_intervals

BIN = 1_000_000
MIN_UNMASKED = 0.25


def reads_aligned(alignments: DataFrame) -> DataFrame:
    return alignments.agg(F.count_if(cigar.is_primary(F.col("flag"))).alias("reads_aligned"))


def _starts(alignments: DataFrame) -> DataFrame:
    return alignments.where("ref_id >= 0").select("ref_id", cigar.start1(F.col("pos0")).alias("start"))


def bin_counts(alignments: DataFrame, width: int = BIN, contig_length: int | None = None) -> DataFrame:
    """Every mapped record, secondary ones too, counts once in the bin of its start."""
    starts = _starts(alignments)
    if contig_length is not None:
        starts = starts.where(F.col("start") < contig_length)
    return starts.groupBy("ref_id", F.floor(F.col("start") / width).cast("int").alias("bin")).agg(F.count("*").alias("reads"))


def with_length(df: DataFrame, contig_length: int | DataFrame) -> DataFrame:
    """``df`` with ``_length``: one for all contigs, or that of its own in a table (ref_id, length), of which rows on other contigs go."""
    if isinstance(contig_length, DataFrame):
        return df.join(contig_length.select("ref_id", F.col("length").alias("_length")), "ref_id")
    return df.withColumn("_length", F.lit(contig_length))


def masked_bin_depth(alignments: DataFrame, repeats: DataFrame, contig_length: int | DataFrame, width: int = BIN, min_unmasked: float = MIN_UNMASKED) -> DataFrame:
    """Unmasked starts per bin, scaled to a full bin; bins with little unmasked sequence are left out.

    Repeats become disjoint intervals.  A start is masked if one holds it: an anti-join on (contig, bin), never a scan of all repeats.
    A short last bin is compared with the full width; ``contig_length`` may be a table (ref_id, length), each contig its own.
    """
    merged = union_intervals(repeats.select("ref_id", "st", "en").where("st < en"))
    clipped = with_length(merged, contig_length).select("ref_id", "st", F.least("en", "_length").alias("en")).where("st < en")
    dealt = clipped.withColumn("bin", F.explode(bins(F.col("st"), F.col("en") - 1, width))).select(F.col("ref_id").alias("_r"), F.col("bin").alias("_b"), "st", "en")
    starts = with_length(_starts(alignments), contig_length).where(F.col("start") < F.col("_length")).withColumn("bin", F.floor(F.col("start") / width).cast("int"))
    free = starts.join(dealt, (F.col("ref_id") == F.col("_r")) & (F.col("bin") == F.col("_b")) & (F.col("start") >= F.col("st")) & (F.col("start") < F.col("en")), "left_anti")
    reads = free.groupBy("ref_id", "bin").agg(F.count("*").alias("reads"), F.max("_length").alias("_length"))
    masked = covered_by_bin(clipped, width)
    size = F.least((F.col("bin") + 1) * width, F.col("_length")) - F.col("bin") * width
    both = reads.join(masked, ["ref_id", "bin"], "left").withColumn("unmasked", size - F.coalesce("covered", F.lit(0)))
    return both.where(F.col("unmasked") > min_unmasked * width).select("ref_id", "bin", "reads", "unmasked", (F.col("reads") * width / F.col("unmasked")).alias("depth"))


def gc_fraction(reference: DataFrame) -> DataFrame:
    """G and C among A, C, G and T of each chunk; null where it has none of them."""
    bases = F.length(F.regexp_replace("seq", "[^ACGT]", ""))
    gc = F.length(F.regexp_replace("seq", "[^GC]", ""))
    return reference.select("ref_id", "chunk_no", F.when(bases > 0, gc / bases).alias("gc"))
