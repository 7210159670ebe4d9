"""All analyses over one set of alignments, as one result document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociforge.operators import coverage, junctions, karyotype, pileup, structural
from lociforge.plans import document, snv
from lociforge.sources import config


@dataclass(frozen=True)
class Thresholds:
    """Every cut-off of the analyses, with the usual defaults."""

    bin_width: int = 1_000_000
    site_depth: int = 20
    margin: int = 5000
    min_anchor: int = 500
    fusion_reads: int = 3
    breakpoint_reads: int = 1
    deldup_reads: int = 3
    itd_length: int = 4
    itd_frequency: float = 0.0
    snv_coverage: int = 10
    snv_frequency: float = 0.3


@dataclass(frozen=True)
class Inputs:
    """What a run reads; ``regions`` are those searched for insertions, ``contig_length`` is one for all contigs or a table (ref_id, name, chrom, length).

    Small variants need ``cds`` (gene, ref_id, st, en, strand) and ``reference`` (ref_id, chunk_no, seq); ``stars`` are positions by allele by gene.
    ``rules`` are a panel's for fusions; ``partners`` (gene, seqid, st, en) bounds the partners that they list, ``seqid`` being a contig's chromosome name.
    ``insertion_limits`` are least lengths and frequencies by region's name; other regions take the thresholds.
    ``deldup_genes`` and ``excluded`` limit where deletions are looked for and which genes make the focal baseline.
    """

    alignments: DataFrame
    targets: DataFrame
    repeats: DataFrame
    sites: DataFrame
    contig_length: int | DataFrame
    regions: DataFrame | None = None
    centromeres: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    cds: DataFrame | None = None
    reference: DataFrame | None = None
    stars: Mapping[str, Mapping[str, Sequence[int]]] = field(default_factory=dict)
    rules: config.FusionRules | None = None
    partners: DataFrame | None = None
    deldup_genes: Sequence[str] | None = None
    excluded: tuple[str, ...] = ()
    metadata: Mapping[str, str | None] | None = None
    insertion_limits: Mapping[str, tuple[int, float]] = field(default_factory=dict)


def analyses(inputs: Inputs, t: Thresholds = Thresholds()) -> dict[str, DataFrame]:
    """The analyses' tables, not yet run; they share one pruned scan if the caller persists ``alignments``."""
    reads = inputs.alignments
    splits = structural.split_alignments(reads)
    looked = inputs.targets if inputs.deldup_genes is None else inputs.targets.where(F.col("nm").isin(list(inputs.deldup_genes)))
    return {
        "reads_aligned": coverage.reads_aligned(reads),
        "coverage": coverage.masked_bin_depth(reads, inputs.repeats, inputs.contig_length, t.bin_width),
        "maf": pileup.site_allele_counts(reads, inputs.sites, t.site_depth),
        "qc": pileup.qc_on_target(reads, inputs.targets),
        "focal": structural.focal_copies(pileup.focal_depth(reads, inputs.targets), inputs.excluded),
        "fusions": fusion_calls(inputs, t),
        "deldups": structural.deldup_clusters(structural.deldup_candidates(splits, t.min_anchor), t.deldup_reads),
        "gene_deldups": structural.gene_deldups(splits, looked, t.min_anchor, t.deldup_reads),
        "itd": insertion_calls(inputs, t),
    }


def insertion_calls(inputs: Inputs, t: Thresholds = Thresholds()) -> DataFrame:
    """Insertions in the regions, a pass for each pair of limits that a panel names (a few)."""
    regions = inputs.regions if inputs.regions is not None else inputs.targets
    own = F.col("nm").isin(list(inputs.insertion_limits))
    out = pileup.internal_duplications(inputs.alignments, regions.where(~own), t.itd_length, t.itd_frequency)
    for limits in sorted(set(inputs.insertion_limits.values())):
        names = [g for g, mine in inputs.insertion_limits.items() if mine == limits]
        out = out.unionByName(pileup.internal_duplications(inputs.alignments, regions.where(F.col("nm").isin(names)), *limits))
    return out


def fusion_calls(inputs: Inputs, t: Thresholds = Thresholds()) -> DataFrame:
    """Fusion events at the targets, by the panel's rules where there are some: margins by gene, one-sided genes, their listed partners and least share of depth.

    A pair of genes that the rules let bypass the filter keeps its events whatever their breakpoints' reads.
    """
    reads, rules, targets, margin = inputs.alignments, inputs.rules, inputs.targets, t.margin
    if rules is not None:
        targets, margin = rules.margins(targets), F.col("margin")
    at_targets = structural.splits_at(reads, targets, margin, t.min_anchor)
    clear = at_targets.join(structural.ambiguous(at_targets, targets, margin, t.min_anchor), ["read_name", "aln_no"], "left_anti")
    located = structural.loci(clear, targets, margin, t.min_anchor)
    if rules is None:
        return structural.fusion_events(structural.breakpoints(structural.locus_pairs(located), t.min_anchor), targets, margin, t.fusion_reads, t.breakpoint_reads)
    found = structural.locus_pairs(located, sorted(rules.one_sided), tuple(rules.skip_self))
    events = structural.fusion_events(structural.breakpoints(found, t.min_anchor), targets, margin, t.fusion_reads, 1)
    a, b = F.col("g0.gene"), F.col("g1.gene")
    one_sided = (a == "") | (b == "")
    events = events.where((F.col("n_reads") >= rules.needed_reads(one_sided)) | rules.bypasses(a, b))
    if inputs.partners is not None and rules.partners:
        far = F.when(a == "", F.struct(F.col("g0.ref_id").alias("ref_id"), F.col("pos0").alias("pos"))).otherwise(F.struct(F.col("g1.ref_id").alias("ref_id"), F.col("pos1").alias("pos")))
        alone = named(events.where(one_sided).withColumn("gene", F.when(a == "", b).otherwise(a)).withColumn("_far", far).select("*", "_far.*"), inputs.contig_length)
        near = config.near_listed(alone.withColumnRenamed("chrom", "seqid"), inputs.partners, rules.partners, t.margin)
        events = events.where(~one_sided).unionByName(near.select(*events.columns))
    if rules.one_sided_fraction is not None:
        events = structural.drop_rare_one_sided(events, pileup.focal_depth(reads, inputs.targets), rules.one_sided_fraction)
    return events


def named(df: DataFrame, contigs: int | DataFrame) -> DataFrame:
    """``df`` with ``chrom``: by a table (ref_id, chrom), rows on unnamed contigs gone; without one, contigs 0 to 23 are chromosomes 1 to 22, X and Y."""
    if isinstance(contigs, DataFrame):
        return df.join(contigs.where("chrom is not null").select("ref_id", "chrom"), "ref_id")
    number = F.col("ref_id")
    return df.withColumn("chrom", F.concat(F.lit("chr"), F.when(number == 22, "X").when(number == 23, "Y").otherwise((number + 1).cast("string"))))


def segments(depth: DataFrame, width: int, centromeres: Mapping[str, tuple[int, int]], contigs: int | DataFrame = 0) -> DataFrame:
    """Binned depth as (chrom, st, en, segment, coverage) rows."""
    placed = named(depth, contigs).select("chrom", (F.col("bin") * width).alias("st"), ((F.col("bin") + 1) * width).alias("en"), F.col("depth").alias("coverage"))
    return placed.withColumn("segment", karyotype.arm(F.col("chrom"), F.col("st"), F.col("en"), centromeres))


def breakpoint_consensus(reads: DataFrame, fusions: Sequence[Mapping], min_reads: int) -> list[dict]:
    """Consensus across each called fusion's breakpoint; none where alignments carry no ``seq``.  A sample's called events go into the plan."""
    if "seq" not in reads.columns or not fusions:
        return []
    rows = [(str(i), f["g0"]["ref_id"], f["pos0"], f["dir0"], f["g1"]["ref_id"], f["pos1"], f["dir1"], f["g0"]["gene"], f["g1"]["gene"]) for i, f in enumerate(fusions)]
    events = reads.sparkSession.createDataFrame(rows, "event string, ref0 int, pos0 int, dir0 string, ref1 int, pos1 int, dir1 string, gene0 string, gene1 string")
    found = junctions.junction_consensus(junctions.junction_sequences(reads, events), events, min_reads)
    return [r.asDict() for r in events.select("event", "ref0", "gene0", "pos0", "ref1", "gene1", "pos1").join(found, "event").orderBy(F.col("event").cast("int")).drop("event").collect()]


def copies(inputs: Inputs, bins: DataFrame, calls: Sequence[Mapping]) -> tuple[DataFrame, DataFrame]:
    """Focal and local copies against a karyotype's diploid arms: their genes' depths, and the mean of their medians.  The tumour share is 1 at most."""
    diploid = {c["segment"]: c["median"] for c in calls if c["cn"] == 2}
    share = next((c["blast_ratio"] for c in calls if c["blast_ratio"] is not None), None)
    share = None if share is None else min(share, 1.0)
    placed = named(inputs.targets, inputs.contig_length).withColumn("segment", karyotype.arm(F.col("chrom"), F.col("st"), F.col("en"), inputs.centromeres))
    genes = placed.where(F.col("segment").isin(list(diploid)) if diploid else ~F.col("chrom").isin("chrX", "chrY"))
    names = [r[0] for r in genes.select("nm").distinct().collect()]  # the panel
    focal = structural.focal_copies(pileup.focal_depth(inputs.alignments, inputs.targets), inputs.excluded, tumour=share, diploid=names)
    numbers = placed.select("ref_id", "chrom").distinct()
    by_number = bins.join(numbers, "chrom").select("ref_id", F.col("st").alias("b_st"), F.col("en").alias("b_en"), "coverage")
    return focal, structural.local_copies(by_number, inputs.targets, share, sum(diploid.values()) / len(diploid) if diploid else None)


def contig_names(contigs: int | DataFrame) -> dict[int, str] | None:
    """Names by number, as they stand in the index; an index has tens to thousands of lines."""
    if not isinstance(contigs, DataFrame):
        return None
    name = "name" if "name" in contigs.columns else "chrom"
    return {r["ref_id"]: r[name] or "" for r in contigs.select("ref_id", name).collect()}


def result_document(spark: SparkSession, inputs: Inputs, t: Thresholds = Thresholds()) -> dict:
    """One sample's result: what is collected are calls and per-gene figures, never reads or bins."""
    tables = analyses(inputs, t)
    rows = lambda df: [r.asDict(recursive=True) for r in df.collect()]
    names = contig_names(inputs.contig_length)
    bins = segments(tables["coverage"], t.bin_width, inputs.centromeres, inputs.contig_length).withColumn("sample", F.lit("sample"))
    allele = named(tables["maf"], inputs.contig_length).withColumn("segment", karyotype.arm(F.col("chrom"), F.col("pos"), F.col("pos"), inputs.centromeres))
    maf = allele.select(F.lit("sample").alias("sample"), "segment", (F.least("ref", "alt") / (F.col("ref") + F.col("alt"))).alias("maf"))
    calls = rows(karyotype.call_karyotypes(bins, maf=maf))
    spread = karyotype.within_segment_spread(bins).select(F.expr("iqr_of_iqrs / nullif(median_iqr, 0)")).first()[0]
    focal, local = copies(inputs, bins, calls)
    fusions = rows(tables["fusions"])
    aligned, quality = tables["reads_aligned"].first()[0], rows(tables["qc"])[0]
    depths = {r["nm"]: r["depth"] for r in rows(focal) if r["depth"] is not None}
    figures = {k: float(v) for k, v in quality.items() if v is not None}
    mean = {"mean_coverage": figures["nt_on_target"] / figures["target_regions_nt"]} if figures.get("target_regions_nt") else {}
    searched = [r[0] for r in inputs.regions.select("nm").distinct().collect()] if inputs.regions is not None else []  # the panel's
    stamp = spark.range(1).select(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0]
    variants = None
    if inputs.cds is not None and inputs.reference is not None:
        found = snv.small_variants(inputs.alignments, inputs.cds, inputs.reference, inputs.stars, t.snv_coverage, t.snv_frequency)
        variants = document.small_variants({name: rows(df) for name, df in found.items()})
    return document.known(
        version="1", timestamp=stamp, metadata=dict(inputs.metadata) if inputs.metadata else None, qc=figures | mean | {"reads_aligned": aligned, "target_coverage": depths},
        fusions=document.fusions(fusions, names, inputs.rules.spike_in if inputs.rules else None), karyotype=document.karyotype(calls, aligned, spread),
        cnv=document.copies(rows(focal), rows(local), rows(tables["gene_deldups"]), names), snv=variants, itd=document.insertions(rows(tables["itd"]), searched),
        breakpoint_consensus=document.consensus(breakpoint_consensus(inputs.alignments, fusions, t.fusion_reads), names),
    )
