"""Cohorts: results of many samples filtered and laid out as one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.functions import texts

MISSING = "MISSING"


def names_any(gene: Column, parts: Sequence[str]) -> Column:
    """Whether a gene's name holds any of the parts."""
    out = F.lit(False)
    for part in parts:
        out = out | gene.contains(part)
    return out


def unordered_pair_in(a: Column, b: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whether (a, b) or (b, a) is listed; a side without a gene never is."""
    out = F.lit(False)
    for x, y in pairs:
        out = out | ((F.least(a, b) == min(x, y)) & (F.greatest(a, b) == max(x, y)))
    return out & (a != "") & (b != "")


def filter_fusions(fusions: DataFrame, blacklist: Sequence[tuple[str, str]] = (), special: Sequence[str] = (), min_reads: int = 3, min_breakpoint_reads: int = 2) -> DataFrame:
    """Fusions with enough reads and a supported breakpoint (special genes need none), off the blacklist; ``kind`` tells sides."""
    a, b = F.col("gene1"), F.col("gene2")
    supported = F.exists("breakpoints", lambda x: x["n_reads"] >= min_breakpoint_reads)
    kept = fusions.where(~unordered_pair_in(a, b, blacklist) & (F.col("reads") >= min_reads) & (supported | names_any(a, special) | names_any(b, special)))
    return kept.withColumn("kind", F.when((a == "") | (b == ""), "one_sided").otherwise("two_sided"))


def wide_table(samples: DataFrame, fusions: DataFrame) -> DataFrame:
    """A row per sample with its fusions as texts in order of id, ``MISSING`` without any; a sample's results are one document."""
    text = F.concat("gene1", F.lit(" ("), F.col("pos1").cast("string"), F.lit(") :: "), "gene2", F.lit(" ("), F.col("reads").cast("string"), F.lit(" reads)"))
    listed = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("id", text.alias("t")))))
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x["t"]), "; "))
    per = fusions.groupBy("sample").agg(listed("two_sided").alias("two"), listed("one_sided").alias("one"))
    out = samples.join(per, "sample", "left")
    return out.select("sample", F.coalesce(joined(F.col("two")), F.lit(MISSING)).alias("fusions"), F.coalesce(joined(F.col("one")), F.lit(MISSING)).alias("one_sided_fusions"))


def document_fusions(documents: DataFrame, section: str = "fusions") -> DataFrame:
    """Fusions of result documents as (sample, id, gene1, gene2, pos1, reads, breakpoints), with the genes' places as text; ``id`` is the place in the document."""
    each = documents.select("sample", F.posexplode(f"fusions.{section}").alias("id", "x"))
    places = [texts.gene_text(F.col(f"x.gene{k}.name"), F.col(f"x.gene{k}.chr"), F.col(f"x.gene{k}.pos")).alias(f"text{k}") for k in (1, 2)]
    return each.select("sample", "id", F.col("x.gene1.name").alias("gene1"), F.col("x.gene2.name").alias("gene2"), F.col("x.supporting_reads").alias("reads"), F.col("x.breakpoints").alias("breakpoints"), *places)


@dataclass(frozen=True)
class Columns:
    """Which genes a cohort table shows, by kind of call, and the columns' order (null: as they come)."""

    local: Sequence[str] = ()
    focal: Sequence[str] = ()
    deletions: Sequence[str] = ()
    duplications: Sequence[str] = ()
    insertions: Mapping[str, str] = field(default_factory=dict)
    variants: Sequence[str] = ()
    order: Sequence[str] | None = None


def _gene_cells(columns: Columns) -> dict[str, Column]:
    """A cell per gene and kind; ``texts`` has their wording.  Genes with both local and focal copies show focal ones."""
    at = lambda section, gene: F.try_element_at(f"{section}.genes", F.lit(gene))
    copies = lambda c, gap: F.when(c.isNotNull(), F.format_string(f"%dx{gap}(%.1fx)", F.round(c).cast("long"), c))
    several = lambda c, f: F.when(F.size(c) > 0, F.array_join(F.transform(c, f), "; "))
    spans = lambda c: several(c, lambda v: texts.span_text(v["chrom"], v["start"], v["end"], v["reads"]))
    inserted = lambda c: several(c, lambda e: texts.insertion_text(e["length"], e["position"], e["merged"], e["coverage"], texts.allelic_ratio(e["merged"], e["coverage"], F.lit(0.0))))
    cells = {g: copies(at("cnv", g)["local"], " ") for g in columns.local}
    cells |= {g: copies(at("cnv", g)["focal"], " ") for g in columns.focal}
    cells |= {f"{g}_deletions": F.coalesce(spans(at("cnv", g)["deletions"]), copies(at("cnv", g)["focal"], "  ")) for g in columns.deletions}
    cells |= {f"{g}_ITD": spans(at("cnv", g)["duplications"]) for g in columns.duplications}
    cells |= {f"{g}_{label}": inserted(at("itd", g)) for g, label in columns.insertions.items()}
    for g in columns.variants:
        one = at("snv", g)
        listed = F.transform(F.array_sort(F.map_entries(one["mutations"])), lambda m: F.concat(m["key"], F.lit(": "), m["value"], F.lit(" AF")))
        cells |= {f"{g}_depth": F.when(one["coverage"].isNotNull(), F.format_string("%.2f", one["coverage"])), f"{g}_mutations": F.array_join(listed, "; "), f"{g}_genotype": one["genotype"]}
    return cells


def cohort_table(documents: DataFrame, columns: Columns = Columns(), blacklist: Sequence[tuple[str, str]] = (), special: Sequence[str] = (), min_reads: int = 3, min_breakpoint_reads: int = 2) -> DataFrame:
    """A row per sample: fusions, karyotype, figures of quality and sequencing, and the cells of ``columns``; ``MISSING`` without.

    ``documents`` have the columns of ``sources.schema.RESULT`` and ``sample``.  A listed order chooses the columns after ``sample``; unknown ones are ``MISSING``.
    """
    kept = filter_fusions(document_fusions(documents), blacklist, special, min_reads, min_breakpoint_reads).select("sample", "id", "kind", "text1", "text2", "reads")
    controls = document_fusions(documents, "spike_in").select("sample", "id", F.lit("spike_in").alias("kind"), "text1", "text2", "reads")
    line = F.concat("text1", F.lit(" :: "), "text2", F.lit(" ("), F.col("reads").cast("string"), F.lit(" reads)"))
    listed = lambda kind: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("id", line.alias("t"))))), lambda x: x["t"]), "; ")
    kinds = {"fusions": "two_sided", "one_sided_fusions": "one_sided", "spike_in": "spike_in"}
    texts_of = kept.unionByName(controls).groupBy("sample").agg(*[listed(kind).alias(f"_{name}") for name, kind in kinds.items()])
    shown = documents.join(texts_of, "sample", "left")
    number = lambda c: F.when(c.isNotNull(), F.format_string("%.2f", c))
    per = lambda a, b: F.col(f"qc.{a}") / F.when(F.col(f"qc.{b}") > 0, F.col(f"qc.{b}"))
    cells = {name: F.col(f"_{name}") for name in kinds} | {
        "karyotype": F.col("karyotype.karyotype_string"), "ISCN": F.col("karyotype.iscn_string"), "warnings": F.replace("karyotype.warnings", F.lit("\n"), F.lit(";")),
        "reads_aligned": F.coalesce("qc.reads_aligned", "karyotype.reads_aligned").cast("string"), "on_target_read_length": per("nt_on_target", "reads_on_target").cast("long").cast("string"),
        "on_target_depth": number(per("nt_on_target", "target_regions_nt")), "seq_date": F.col("metadata.run_start_time"), "seq_ID": F.col("metadata.run_id"),
        "basecalling_model": F.col("metadata.basecall_model"), "library_ID": F.col("metadata.library_id"), "sequencer_ID": F.col("metadata.sequencer_id"), "flow_cell_ID": F.col("metadata.flow_cell_id"),
    } | _gene_cells(columns)
    order = list(cells) if columns.order is None else [c for c in columns.order if c != "sample"]
    known = [F.when(c.isNull() | (c == ""), MISSING).otherwise(c).alias(name) for name in order for c in [cells.get(name, F.lit(MISSING))]]
    return shown.select("sample", *known).orderBy("sample")
