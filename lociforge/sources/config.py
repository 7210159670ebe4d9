"""Panel and genome configurations: JSON read on the driver, with defaults and lookups."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.operators.annotation import attribute
from lociforge.operators.cohort import names_any, unordered_pair_in

Pairs = Sequence[tuple[str, str]]


@dataclass(frozen=True)
class Genome:
    """A reference assembly's centromeres and pseudo-autosomal regions, by chromosome."""

    name: str
    centromeres: Mapping[str, tuple[int, int]]
    par1: Mapping[str, tuple[int, int]]
    par2: Mapping[str, tuple[int, int]]


def read_genome(text: str) -> Genome:
    """All four entries must be there."""
    got = json.loads(text)
    spans = lambda key: {k: (int(a), int(b)) for k, (a, b) in got[key].items()}
    return Genome(got["name"], spans("centromeres"), spans("par1"), spans("par2"))


@dataclass(frozen=True)
class Insertion:
    """A region searched for insertions; the defaults are fixed values of the configuration's format."""

    chrom: str
    start: int
    end: int
    min_length: int = 3
    min_frequency: float = 0.0
    label: str = "ITD"


def read_insertions(text: str) -> dict[str, Insertion]:
    """The regions of a flat gene map, or of a whole panel configuration."""
    got = json.loads(text)
    flat = got["genes"].get("itd", {}) if "genes" in got else got
    return {gene: Insertion(**{k: v for k, v in one.items() if k in Insertion.__dataclass_fields__}) for gene, one in flat.items()}


@dataclass(frozen=True)
class FusionRules:
    """How fusions are called and kept; gene names match in part, pairs in either order."""

    margin: int
    special_margins: Mapping[str, int] = field(default_factory=dict)
    skip_self: Sequence[str] = ()
    bypass: Sequence[str] = ()
    blacklist: Pairs = ()
    spike_in: tuple[str, str] | None = None
    one_sided: frozenset[str] = frozenset()
    partners: Mapping[str, Sequence[str]] = field(default_factory=dict)
    breakpoint_reads: int = 1
    one_sided_breakpoint_reads: int | None = None
    one_sided_fraction: float | None = None

    def margins(self, targets: DataFrame, gene: str = "nm") -> DataFrame:
        """``targets`` with ``margin``: the gene's own or the default."""
        out = F.lit(self.margin)
        for name, wide in self.special_margins.items():
            out = F.when(F.col(gene) == name, wide).otherwise(out)
        return targets.withColumn("margin", out)

    def is_blacklisted(self, a: Column, b: Column) -> Column:
        return unordered_pair_in(a, b, self.blacklist)

    def is_spike_in(self, a: Column, b: Column) -> Column:
        return unordered_pair_in(a, b, [self.spike_in] if self.spike_in else [])

    def skips_self(self, a: Column, b: Column) -> Column:
        return names_any(a, self.skip_self) & names_any(b, self.skip_self)

    def bypasses(self, a: Column, b: Column) -> Column:
        return names_any(a, self.bypass) | names_any(b, self.bypass)

    def needed_reads(self, one_sided: Column) -> Column:
        """Reads that a breakpoint needs; the one-sided number where it is set."""
        return F.when(one_sided, self.one_sided_breakpoint_reads if self.one_sided_breakpoint_reads is not None else self.breakpoint_reads).otherwise(self.breakpoint_reads)

    def listed_partners(self) -> set[str]:
        return {p for names in self.partners.values() for p in names}


def read_fusion_rules(text: str, default_margin: int = 5000) -> FusionRules:
    """The fusion part of a panel configuration; absent entries take their defaults."""
    got = json.loads(text)
    rules, cuts = got["genes"].get("fusions", {}), got.get("thresholds", {}).get("fusions", {})
    alone, spike = cuts.get("one_sided", {}), rules.get("spike_in")
    return FusionRules(
        margin=cuts.get("default_margin", default_margin), special_margins=rules.get("special_margins", {}), skip_self=tuple(rules.get("skip_self_fusions", ())),
        bypass=tuple(rules.get("bypass_breakpoint_filter", ())), blacklist=[tuple(p) for p in rules.get("blacklist_pairs", ())], spike_in=(spike["gene1"], spike["gene2"]) if spike else None,
        one_sided=frozenset(rules.get("one_sided_genes", ())), partners=rules.get("one_sided_partners", {}), breakpoint_reads=cuts.get("min_breakpoint_reads", 1),
        one_sided_breakpoint_reads=alone.get("min_breakpoint_reads"), one_sided_fraction=alone.get("min_fraction"),
    )


def gene_bounds(gff: DataFrame, names: Sequence[str]) -> DataFrame:
    """(gene, seqid, st, en) of the named genes' own lines; of a name's several lines the last by place."""
    name = attribute(F.col("attributes"), "Name")
    found = gff.where((F.col("type") == "gene") & name.isin(list(names)) & (F.col("start") > 0) & (F.col("end") > 0))
    last = found.groupBy(name.alias("gene")).agg(F.max(F.struct("seqid", "start", "end")).alias("b"))
    return last.select("gene", F.col("b.seqid").alias("seqid"), F.col("b.start").alias("st"), F.col("b.end").alias("en"))


def near_listed(points: DataFrame, bounds: DataFrame, partners: Mapping[str, Sequence[str]], margin: int) -> DataFrame:
    """Points (gene, seqid, pos) within ``margin``, ends included, of a partner listed for their gene; a gene without a list passes.

    ``seqid`` must follow one naming on both sides (``functions.contig.translate``).  The panel's bounds are broadcast.
    """
    pairs = [(g, p) for g, names in partners.items() for p in names]
    if not pairs:
        return points
    spark = points.sparkSession
    listed = spark.createDataFrame(pairs, "_g string, _p string").join(bounds.withColumnRenamed("gene", "_p"), "_p")
    wide = F.broadcast(listed.select("_g", F.col("seqid").alias("_s"), F.greatest(F.col("st") - margin, F.lit(0)).alias("_st"), (F.col("en") + margin).alias("_en")))
    near = points.join(wide, (F.col("gene") == F.col("_g")) & (F.col("seqid") == F.col("_s")) & F.col("pos").between(F.col("_st"), F.col("_en")), "left_semi")
    return near.unionAll(points.where(F.col("gene").isNull() | ~F.col("gene").isin(list(partners))))
