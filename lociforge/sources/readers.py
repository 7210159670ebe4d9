"""Text inputs as DataFrames: BED, sites, GFF3, coverage and allele tables, gene lists, result documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))


def _need(row, n: int, what: str):
    """``row`` if it has ``n`` fields, else an error that shows the line."""
    return F.when(F.size(row) >= n, row).otherwise(F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.col("value"))).cast("array<string>"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(segment, start, end, name) of a BED file; the name is ``segment:start-end`` where there is none; a line of fewer than three fields is an error."""
    f = _lines(spark, path).select(_need(F.split("value", "\t"), 3, "BED").alias("f"))
    got = f.select(F.col("f")[0].alias("segment"), F.col("f")[1].cast("int").alias("start"), F.col("f")[2].cast("int").alias("end"), F.get("f", 3).alias("name"))
    return got.withColumn("name", F.coalesce("name", F.format_string("%s:%d-%d", "segment", "start", "end")))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ref, alt) of known sites on chromosomes 1 to 22, X and Y with single A, C, G, T alleles; shorter lines are skipped."""
    f = _lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 4)
    got = f.select(F.regexp_replace(F.col("f")[0], "^chr", "").alias("chrom"), F.col("f")[1].cast("int").alias("pos"), F.col("f")[2].alias("ref"), F.col("f")[3].alias("alt"))
    return got.where(F.col("chrom").rlike("^([1-9]|1[0-9]|2[0-2]|X|Y)$") & F.col("ref").isin(*"ACGT") & F.col("alt").isin(*"ACGT"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """The nine columns of a GFF3 file, and ``ord``, which rises in the file's order."""
    f = _lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 9)
    names = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")
    return f.select(*[(F.col("f")[i].cast("int") if n in ("start", "end") else F.col("f")[i]).alias(n) for i, n in enumerate(names)], F.monotonically_increasing_id().alias("ord"))


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, st, en, coverage, gc) of a coverage table with header; gc may be missing, NA or NaN: null."""
    rows = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    gc = F.nanvl(F.col("gc_content").cast("double"), F.lit(None).cast("double")) if "gc_content" in rows.columns else F.lit(None).cast("double")
    return rows.select(F.col("chromosome").alias("chrom"), F.col("bin_start").cast("int").alias("st"), F.col("bin_end").cast("int").alias("en"), F.col("n_reads").cast("double").alias("coverage"), gc.alias("gc"))


def read_maf(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ref, alt, maf) of an allele-count table; sites without reads are left out."""
    rows = spark.read.csv(path, sep="\t", header=True, schema="chrom string, pos int, ref int, alt int").where("ref + alt > 0")
    return rows.withColumn("maf", F.least("ref", "alt") / (F.col("ref") + F.col("alt")))


def read_gene_list(spark: SparkSession, path: str) -> list[str]:
    """Trimmed lines of a gene list; a panel's list is short and goes into plans."""
    return [r[0] for r in spark.read.text(path).select(F.trim("value").alias("g")).where("g <> ''").collect()]


def read_results(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Result documents of many samples; ``sample`` is the file's name up to the first dot."""
    found = spark.read.schema(schema).json(pattern, multiLine=True)
    return found.withColumn("sample", F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1))


def read_config(text: str, key: str | None = None) -> dict:
    """A JSON configuration; with a key, that part of it if it is there, else the whole."""
    got = json.loads(text)
    return got.get(key, got) if key else got
