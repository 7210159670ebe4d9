"""Small variants of a panel's genes: calls in coding coordinates, their phase, changed amino acids and star alleles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociforge.functions import dna
from lociforge.operators import genotype, pileup
from lociforge.sources import fasta


def coding_sequences(cds: DataFrame, reference: DataFrame, chunk: int = fasta.CHUNK) -> DataFrame:
    """(gene, seq): a gene's exons (ref_id, st, en; 1-based, closed) in order, on its strand, from ``reference`` (ref_id, chunk_no, seq)."""
    exons = cds.select("gene", "strand", "ref_id", (F.col("st") - 1).alias("st"), "en")
    cut = fasta.region_sequences(reference, exons, chunk, "ref_id")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("st", "seq"))), lambda x: x["seq"]), "")
    joined = cut.groupBy("gene", "strand").agg(whole.alias("seq"))  # a gene's exons: tens
    return joined.select("gene", F.when(F.col("strand") == "-", dna.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def small_variants(
    alignments: DataFrame, cds: DataFrame, reference: DataFrame, stars: Mapping[str, Mapping[str, Sequence[int]]] | None = None,
    min_coverage: int = 10, min_frequency: float = 0.3, chunk: int = fasta.CHUNK,
) -> dict[str, DataFrame]:
    """Tables ``calls``, ``phases``, ``changes``, ``depths`` and, of the genes in ``stars`` (positions by allele), ``genotypes``.

    A gene with alleles but no call at their positions has the genotype ``*1/*1``.
    """
    counts, sequences = pileup.cds_counts(alignments, cds), coding_sequences(cds, reference, chunk)
    bases = sequences.select("gene", F.posexplode(F.split("seq", "")).alias("cds_pos", "ref")).where("ref <> ''")
    calls = pileup.call_variants(counts, bases, min_coverage, min_frequency)
    out = {"calls": calls, "phases": pileup.phase(calls, alignments, cds), "changes": genotype.amino_changes(calls, sequences), "depths": pileup.mean_depth(counts, sequences.select("gene", F.length("seq").alias("size")))}
    tables = []
    for gene, alleles in (stars or {}).items():
        wanted = calls.where((F.col("gene") == gene) & F.col("pos").isin(sorted({p for loci in alleles.values() for p in loci})))
        found = genotype.genotypes(wanted, pileup.phase(wanted, alignments, cds.where(F.col("gene") == gene)), alleles)
        plain = calls.sparkSession.createDataFrame([(gene,)], "gene string").join(found, "gene", "left")
        tables.append(plain.select("gene", F.coalesce("genotype", F.lit("*1/*1")).alias("genotype"), F.coalesce("unassigned", F.array().cast("array<int>")).alias("unassigned")))
    for one in tables:
        out["genotypes"] = out["genotypes"].unionByName(one) if "genotypes" in out else one
    return out
