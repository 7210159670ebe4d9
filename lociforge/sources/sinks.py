"""Outputs: tab-separated tables, one result document, FASTA, reports; none is overwritten unless asked to."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociforge.sources import schema

def write_tsv(df: DataFrame, path: str, force: bool = False) -> None:
    """A table as tab-separated part files with header; null is written NA."""
    df.write.mode("overwrite" if force else "errorifexists").csv(path, sep="\t", header=True, nullValue="NA")


def coverage_table(depth: DataFrame, names: DataFrame, width: int, contig_length: int) -> DataFrame:
    """Binned depth with contig names in the layout of a coverage table; depths are rounded half to even."""
    out = depth.join(names, "ref_id")
    end = F.least((F.col("bin") + 1) * width, F.lit(contig_length))
    return out.select(F.col("name").alias("chromosome"), (F.col("bin") * width).alias("bin_start"), end.alias("bin_end"), F.bround("depth", 0).cast("long").alias("n_reads"))


def gc_adjusted_table(bins: DataFrame, corrected: str = "corrected") -> DataFrame:
    """Corrected bins (chrom, st, en, gc) in the layout of an adjusted coverage table: four places, NaN for what is missing."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    places = lambda c: F.when(number(c).isNull(), "NaN").otherwise(F.format_string("%.4f", number(c)))
    return bins.select(F.col("chrom").alias("chromosome"), F.col("st").alias("bin_start"), F.col("en").alias("bin_end"), places(corrected).alias("n_reads"), places("gc").alias("gc_content"))


def summary(document: Mapping) -> str:
    """A result document in a few lines for the terminal."""
    part = lambda name, key: (document.get(name) or {}).get(key)
    fusions, genes = part("fusions", "fusions") or [], part("cnv", "genes") or {}
    lines = [f"reads aligned: {part('qc', 'reads_aligned') or 0}", f"karyotype: {part('karyotype', 'karyotype_string') or 'not called'}", f"fusions: {len(fusions)}"]
    lines += [f"  {f['gene1']['name'] or '?'} :: {f['gene2']['name'] or '?'} ({f['supporting_reads']} reads)" for f in fusions]
    lines += [f"insertions: {sum(map(len, (part('itd', 'genes') or {}).values()))}"]
    lines += [f"genotype {gene}: {one['genotype']}" for gene, one in sorted((part("snv", "genes") or {}).items()) if one["genotype"]]
    return "\n".join([*lines, f"deletions and duplications: {sum(len(g.get(k) or []) for g in genes.values() for k in ('deletions', 'duplications'))}"])


def guard(path: str, force: bool = False) -> str:
    """Makes the parent folder; refuses an existing file unless forced."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    if os.path.exists(path) and not force:
        raise FileExistsError(f"{path} exists; pass force to overwrite it")
    return path


def validate(document: Mapping) -> list[str]:
    """Where a result document breaks its schema."""
    return schema.violations(document, schema.result_schema())


def write_result(document: Mapping, path: str, force: bool = False) -> None:
    """One sample's nested result as JSON; absent sections are left out."""
    if wrong := validate(document):
        raise ValueError("; ".join(wrong))
    with open(guard(path, force), "w") as f:
        json.dump({k: v for k, v in document.items() if v is not None}, f, indent=2)


def write_fasta(records: Sequence[tuple[str, str]], path: str, force: bool = False, width: int = 80) -> None:
    with open(guard(path, force), "w") as f:
        for name, seq in records:
            f.write(f">{name}\n" + "".join(seq[i : i + width] + "\n" for i in range(0, len(seq), width)))
