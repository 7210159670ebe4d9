"""Texts of results as they stand in cohort tables and reports; their wording is a fixed format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gene_text(name: Column, chrom: Column, pos: Column) -> Column:
    """``NAME (chr ~1.23Mbp)``; the bare name without a place.  Halves of the last digit round up, whatever the binary fraction."""
    return F.when((chrom != "") & (pos != 0), F.format_string("%s (%s ~%.2fMbp)", name, chrom, pos / 1e6)).otherwise(name)


def side_text(chrom: Column, pos: Column, direction: Column) -> Column:
    return F.concat(chrom, F.lit(":"), pos.cast("string"), F.when(direction == "left", "<<").otherwise(">>"))


def breakpoint_text(side0: Column, side1: Column, n_reads: Column, gap: Column) -> Column:
    """Both sides, reads, and shared (hom) or inserted (ins) bases where there are some."""
    bases = F.abs(gap).cast("string")
    extra = F.when(gap > 0, F.concat(F.lit(" ["), bases, F.lit("bp hom]"))).when(gap < 0, F.concat(F.lit(" ["), bases, F.lit("bp ins]"))).otherwise("")
    return F.concat(side0, F.lit(" -- "), side1, F.lit("  ("), n_reads.cast("string"), F.lit(" reads"), extra, F.lit(")"))


def span_text(chrom: Column, start: Column, end: Column, reads: Column) -> Column:
    """A deletion or duplication; ``?`` for a missing contig."""
    return F.format_string("%s: %d - %d (%d nt): %d supporting reads", F.coalesce(chrom, F.lit("?")), start, end, end - start, reads)


def allelic_ratio(merged: Column, coverage: Column, otherwise: Column) -> Column:
    """Merged reads to the others; ``otherwise`` where there are no others (0 in cohort tables, the share of coverage in reports)."""
    return F.when(coverage > merged, merged / F.nullif(coverage - merged, F.lit(0))).otherwise(otherwise)


def insertion_text(length: Column, position: Column, merged: Column, coverage: Column, ratio: Column) -> Column:
    return F.format_string("%d nt insertion at position %d: %d reads (of %d); %.2f AR", length, position, merged, coverage, ratio)
