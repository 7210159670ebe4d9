"""Contig names: chr style, bare and accession style, by one 24-row table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y"]


def accession(index: int, first: int = 60925, version: int = 1) -> str:
    """The accession of the index-th chromosome of the telomere-to-telomere assembly, numbered through from 1 to Y."""
    return f"NC_{first + index:06d}.{version}"


def table(spark: SparkSession) -> DataFrame:
    """(index, chr_name, accession): small and fixed, to be broadcast."""
    rows = F.array(*[F.struct(F.lit(i).alias("index"), F.lit(f"chr{c}").alias("chr_name"), F.lit(accession(i)).alias("accession")) for i, c in enumerate(CHROMOSOMES)])
    return spark.range(1, numPartitions=1).select(F.explode(rows).alias("x")).select("x.*")


def to_chr_name(name: Column) -> Column:
    """``chrN`` for a bare number, X or Y; other names stay."""
    return F.when(name.rlike("^([1-9]|1[0-9]|2[0-2]|X|Y)$"), F.concat(F.lit("chr"), name)).otherwise(name)


def translate(names: DataFrame, column: str, mapper: DataFrame) -> DataFrame:
    """Adds chr_name and index (null: unknown) for chr, bare and accession names."""
    either = mapper.select(F.col("index").alias("_i"), F.col("chr_name").alias("_c"), F.explode(F.array("chr_name", "accession")).alias("_n"))
    joined = names.join(F.broadcast(either), to_chr_name(F.col(column)) == F.col("_n"), "left")
    return joined.select(*names.columns, F.coalesce("_c", F.col(column)).alias("chr_name"), F.col("_i").alias("index"))
