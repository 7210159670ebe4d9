"""Command line: ``python -m lociforge <analysis> --alignments reads.bam --contigs genome.fa.fai ...``.

Contigs are numbered by their order in the index; regions, repeats and sites are named by contig.  Tables are written as tab-separated folders, results as JSON.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociforge.functions import contig
from lociforge.operators import annotation, cohort, coverage, pileup, structural
from lociforge.plans import pipeline, snv
from lociforge.sources import bam, config, fasta, readers, report, schema, sinks

#: Analyses that write one table, and what each needs beside alignments.
TABLES = {"coverage": ("repeats",), "maf": ("sites",), "qc": ("targets",), "focal": ("targets",), "fusions": ("targets",), "deldup": (), "itd": ("targets",), "reads": ()}


def contig_numbers(spark: SparkSession, path: str) -> tuple[dict[str, int], DataFrame]:
    """Number by name, and the contigs as (ref_id, name, chrom, length); an index has tens to thousands of lines."""
    names, rows = {}, []
    for (line,) in spark.read.text(path).where("trim(value) <> ''").collect():
        name, length = line.split("\t")[:2]
        rows.append((len(names), name, int(length)))
        names[name] = len(names)
    translated = contig.translate(spark.createDataFrame(rows, "ref_id int, name string, length int"), "name", contig.table(spark))
    return names, translated.select("ref_id", "name", F.when(F.col("index").isNotNull() | F.col("chr_name").startswith("chr"), F.col("chr_name")).alias("chrom"), "length")


def numbered(df: DataFrame, column: str, numbers: dict[str, int]) -> DataFrame:
    """``df`` with ref_id; rows on other contigs go.  Names with and without ``chr`` are the same."""
    rows = [(k.removeprefix("chr"), v) for k, v in numbers.items()]
    known = df.sparkSession.createDataFrame(rows, "_n string, ref_id int")
    return df.join(known, F.regexp_replace(column, "^chr", "") == F.col("_n")).drop("_n")


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """A BAM pattern, or a Parquet table in the same columns."""
    if ".bam" in path:
        spark.dataSource.register(bam.BamDataSource)
        return spark.read.format("bam").load(path)
    return spark.read.parquet(path)


def regions(spark: SparkSession, path: str | None, numbers: dict[str, int]) -> DataFrame:
    """A BED file as (ref_id, st, en, nm, ord); ``ord`` rises in the file's order.  Without a file: none."""
    if path is None:
        return spark.createDataFrame([], "ref_id int, st int, en int, nm string, ord long")
    named = numbered(readers.read_bed(spark, path).withColumn("ord", F.monotonically_increasing_id()), "segment", numbers)
    return named.select("ref_id", F.col("start").alias("st"), F.col("end").alias("en"), F.col("name").alias("nm"), "ord")


def _json(path: str | None) -> dict:
    if not path:
        return {}
    with open(path) as f:
        return json.load(f)


def read_panel(path: str | None) -> report.Panel | None:
    """A panel configuration with its fusion rules; without a file: none."""
    if not path:
        return None
    got = _json(path)
    return report.read_panel(got, config.read_fusion_rules(json.dumps({"genes": {}} | got)))


def coding_regions(gff: DataFrame, numbers: dict[str, int], genes: Sequence[str], transcripts: dict[str, str] | None = None) -> DataFrame:
    """(gene, ref_id, st, en, strand) of the genes' coding exons: of the transcript named for a gene, else of its longest."""
    placed = numbered(gff, "seqid", numbers)
    places = placed.where("type = 'gene'").select(annotation.attribute(F.col("attributes"), "Name").alias("gene"), "ref_id").distinct()
    chosen = transcripts or {}
    cds = annotation.longest_cds(placed).where(F.col("gene").isin([g for g in genes if g not in chosen]))
    for gene in (g for g in genes if g in chosen):  # a panel's
        cds = cds.unionByName(annotation.longest_cds(placed, chosen[gene]).where(F.col("gene") == gene))
    return cds.join(places, "gene").select("gene", "ref_id", F.col("start").alias("st"), F.col("end").alias("en"), "strand")


def genome_chunks(spark: SparkSession, args: argparse.Namespace, numbers: dict[str, int]) -> DataFrame:
    return numbered(fasta.read_fasta(spark, args.reference, index=args.contigs), "contig", numbers).select("ref_id", "chunk_no", "seq")


def inputs(spark: SparkSession, args: argparse.Namespace) -> pipeline.Inputs:
    numbers, contigs = contig_numbers(spark, args.contigs)
    sites = spark.createDataFrame([], "ref_id int, pos int, al0 string, al1 string")
    if args.sites:
        sites = numbered(readers.read_sites(spark, args.sites), "chrom", numbers).select("ref_id", "pos", F.col("ref").alias("al0"), F.col("alt").alias("al1"))
    genome = {}
    if args.genome:
        with open(args.genome) as f:
            genome = config.read_genome(f.read()).centromeres
    plain = pipeline.Inputs(read_alignments(spark, args.alignments), regions(spark, args.targets, numbers), regions(spark, args.repeats, numbers), sites, contigs, centromeres=genome)
    return with_panel(spark, args, plain, numbers)


def with_panel(spark: SparkSession, args: argparse.Namespace, plain: pipeline.Inputs, numbers: dict[str, int]) -> pipeline.Inputs:
    """``plain`` with what a panel configuration, an annotation and a genome add."""
    found, got = read_panel(args.panel), _json(args.panel)
    if found is None:
        return plain
    excluded = got.get("genes", {}).get("cnv", {}).get("exclude_from_baseline", ())
    more = {"rules": found.rules, "deldup_genes": sorted({*found.deletions, *found.duplications}), "excluded": tuple(excluded)}
    if found.insertions:
        rows = [(gene, one["chrom"], int(one["start"]), int(one["end"]), i) for i, (gene, one) in enumerate(sorted(found.insertions.items()))]
        more["regions"] = numbered(spark.createDataFrame(rows, "nm string, chrom string, st int, en int, ord int"), "chrom", numbers).select("ref_id", "st", "en", "nm", "ord")
        more["insertion_limits"] = {gene: (one.min_length, one.min_frequency) for gene, one in config.read_insertions(json.dumps(got)).items()}
    if args.gff:
        gff = readers.read_gff(spark, args.gff)
        bounds = config.gene_bounds(gff, sorted(found.rules.listed_partners()))
        more["partners"] = pipeline.named(numbered(bounds, "seqid", numbers), plain.contig_length).select("gene", F.col("chrom").alias("seqid"), "st", "en")
        genes = sorted({*found.drugs, *found.disease, *found.transcripts})
        if args.reference and genes:
            named = {g: one["transcript"] for g, one in found.transcripts.items() if one.get("transcript")}
            more |= {"cds": coding_regions(gff, numbers, genes, named), "reference": genome_chunks(spark, args, numbers), "stars": {g: one["variants"] for g, one in found.transcripts.items() if one.get("variants")}}
    return dataclasses.replace(plain, **more)


def table(name: str, given: pipeline.Inputs, t: pipeline.Thresholds) -> DataFrame:
    """One analysis's table, flat."""
    if name == "deldup":
        out = structural.deldup_clusters(structural.deldup_candidates(structural.split_alignments(given.alignments), t.min_anchor), t.deldup_reads)
    elif name == "reads":
        out = coverage.reads_aligned(given.alignments)
    elif name == "focal":
        out = structural.focal_copies(pileup.focal_depth(given.alignments, given.targets))
    else:
        out = pipeline.analyses(given, t)[name]
    nested = [f.name for f in out.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    return out.withColumns({c: F.to_json(c) for c in nested})


def variants(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Small variants of the genes named, from an annotation and an indexed genome."""
    numbers, _ = contig_numbers(spark, args.contigs)
    genes = [g for g in args.genes.split(",") if g]
    cds, reference, stars = coding_regions(readers.read_gff(spark, args.gff), numbers, genes), genome_chunks(spark, args, numbers), _json(args.stars)
    found = snv.small_variants(read_alignments(spark, args.alignments), cds, reference, stars, args.coverage, args.frequency)
    flat = lambda df: df.withColumns({f.name: F.array_join(f.name, ",") for f in df.schema.fields if f.dataType.typeName() == "array"})
    return {name: flat(df) for name, df in found.items()}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lociforge")
    commands = top.add_subparsers(dest="command", required=True)
    for name in (*TABLES, "pipeline"):
        one = commands.add_parser(name)
        one.add_argument("--alignments", required=True)
        one.add_argument("--contigs", required=True, help="index of the genome: name and length, by tabs")
        for file in ("targets", "repeats", "sites"):
            one.add_argument(f"--{file}", required=file in TABLES.get(name, ()))
        one.add_argument("--genome", help="centromeres as JSON")
        one.add_argument("--panel", help="panel configuration as JSON: fusion rules, genes, insertion regions, alleles")
        one.add_argument("--gff", help="annotation: bounds of listed partners, and with --reference the panel's small variants")
        one.add_argument("--reference", help="the genome as FASTA, indexed by --contigs")
        one.add_argument("--out", required=True)
        one.add_argument("--force", action="store_true")
        for field, value in vars(pipeline.Thresholds()).items():
            one.add_argument(f"--{field.replace('_', '-')}", type=type(value), default=value)
    small = commands.add_parser("snv")
    for name, text in {"alignments": None, "contigs": "index of the genome", "reference": "the genome as FASTA", "gff": "annotation", "genes": "names, by commas", "out": "a folder: a table each for calls, phases, changes, depths, genotypes"}.items():
        small.add_argument(f"--{name}", required=True, help=text)
    small.add_argument("--stars", help="JSON: positions by allele by gene")
    small.add_argument("--coverage", type=int, default=10)
    small.add_argument("--frequency", type=float, default=0.3)
    small.add_argument("--force", action="store_true")
    many = commands.add_parser("cohort")
    many.add_argument("--results", required=True, help="pattern of result documents")
    many.add_argument("--out", required=True)
    many.add_argument("--config", help="JSON: genes by kind of call, blacklist, special genes, least reads, columns")
    many.add_argument("--force", action="store_true")
    page = commands.add_parser("report")
    page.add_argument("--result", required=True)
    page.add_argument("--out", required=True, help="a name that ends in .md or .html")
    page.add_argument("--panel", help="panel configuration as JSON")
    page.add_argument("--targets", help="BED file whose names are listed")
    page.add_argument("--figure", help="karyotype figure to show")
    page.add_argument("--force", action="store_true")
    commands.add_parser("schema")
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "schema":
        print(json.dumps(schema.result_schema(), indent=2))
    elif args.command == "report":
        panel, names = read_panel(args.panel), []
        if args.targets:
            names = [r[0] for r in readers.read_bed(SparkSession.builder.appName("lociforge").getOrCreate(), args.targets).select("name").distinct().collect()]  # the panel's
        text = report.markdown(_json(args.result), panel, names, args.figure)
        with open(sinks.guard(args.out, args.force), "w") as f:
            f.write(report.html(text) if args.out.endswith(".html") else text)
    else:
        spark = SparkSession.builder.appName("lociforge").getOrCreate()
        if args.command == "snv":
            for name, df in variants(spark, args).items():
                sinks.write_tsv(df, f"{args.out}/{name}", args.force)
            return 0
        if args.command == "cohort":
            how = _json(args.config)
            columns = cohort.Columns(how.get("local_cn_genes", ()), how.get("cnv_genes", ()), how.get("deletion_genes", ()), how.get("duplication_genes", ()), how.get("itd_genes", {}), how.get("snv_genes", ()), how.get("columns") or None)
            documents = readers.read_results(spark, args.results, schema.RESULT.replace(" not null", ""))
            blacklist, special = [tuple(p) for p in how.get("fusion_blacklist", ())], list(how.get("fusion_special_genes", ()))
            sinks.write_tsv(cohort.cohort_table(documents, columns, blacklist, special, how.get("min_supporting_reads", 3), how.get("min_breakpoint_reads", 2)), args.out, args.force)
            return 0
        thresholds = pipeline.Thresholds(**{k: getattr(args, k) for k in vars(pipeline.Thresholds())})
        given = inputs(spark, args)
        if args.command == "pipeline":
            document = pipeline.result_document(spark, given, thresholds)
            sinks.write_result(document, args.out, args.force)
            print(sinks.summary(document))
            found = (document.get("breakpoint_consensus") or {}).get("breakpoints", [])
            sinks.write_fasta([(f"{c['gene0_name']}:{c['gene0_pos']}-{c['gene1_name']}:{c['gene1_pos']} reads={c['n_reads']}", c["consensus_sequence"]) for c in found], f"{args.out.removesuffix('.json')}.breakpoints.fa", args.force)
        else:
            sinks.write_tsv(table(args.command, given, thresholds), args.out, args.force)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
