"""Commands over files, cohort documents, and pieces that need long or odd inputs."""

import json
import random

from pyspark.sql import functions as F

from lociforge import __main__ as cli
from lociforge.functions import cigar
from lociforge.operators import annotation, pileup, structural
from lociforge.sources import sinks

ALIGNED = "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string"


def _table(spark, path):
    return [tuple(r) for r in spark.read.csv(str(path), sep="\t", header=True).collect()]


def test_long_cigar_is_placed_as_by_a_running_sum(spark):
    rng = random.Random(5)
    for size in (0, 1, cigar.PIECE, cigar.PIECE + 1, 3 * cigar.PIECE + 17):
        ops = [(rng.choice("MIDNSH=X"), rng.randrange(1, 9)) for _ in range(size)]
        want, t, q = [], 0, 0
        for op, n in ops:
            if op in "MID":
                want.append((op, n, t, q))
            t += n if op in cigar.REFERENCE else 0
            q += n if op in cigar.QUERY else 0
        row = spark.createDataFrame([(ops,)], "cigar array<struct<op:string,len:int>>")
        got = row.select(cigar.placed_ops(F.col("cigar"), ("M", "I", "D")).alias("x")).first().x
        assert [tuple(x) for x in got] == want


def test_reads_at_targets_give_the_same_fusions(spark):
    rng = random.Random(8)
    rows = [(f"r{i % 40}", i // 40 + 1, rng.randrange(2), rng.randrange(60_000), rng.choice([0, 16]), [("S", rng.randrange(3000)), ("M", 1500), ("S", rng.randrange(3000))], None) for i in range(120)]
    reads = spark.createDataFrame(rows, ALIGNED)
    targets = spark.createDataFrame([(0, 10_000, 12_000, "A", 2), (1, 30_000, 31_000, "B", 1), (0, 8_000, 14_000, "C", 3)], "ref_id int, st int, en int, nm string, ord int")
    found = []
    for names in (None, pileup.hit_reads(reads, targets)):
        splits = structural.split_alignments(reads, names)
        clear = splits.join(structural.ambiguous(splits, targets), ["read_name", "aln_no"], "left_anti")
        found.append(sorted(map(str, structural.locus_pairs(structural.loci(clear, targets), ["A", "B", "C"]).collect())))
    assert found[0] == found[1] and found[0]


def test_loci_take_the_first_target_in_file_order(spark):
    splits = spark.createDataFrame([("r", 1, 0, 11_000, 13_000), ("s", 1, 0, 500_000, 501_000), ("t", 1, 5, 11_000, 13_000)], "read_name string, aln_no int, ref_id int, ts int, te int")
    targets = spark.createDataFrame([(0, 10_000, 12_000, "A", 2), (0, 8_000, 14_000, "C", 1)], "ref_id int, st int, en int, nm string, ord int")
    got = {r.read_name: (r.gene, [tuple(x) for x in r.loci]) for r in structural.loci(splits, targets).collect()}
    assert got == {"r": ("C", [(0, 1, "C")]), "s": ("", [(0, 50, ""), (0, 51, "")]), "t": ("", [(5, 1, ""), (5, 2, "")])}


def test_small_variants_from_files(spark, tmp_path):
    genome = "".join(random.Random(3).choice("ACGT") for _ in range(200))
    (tmp_path / "g.fa").write_text(f">chr1\n{genome}\n")
    (tmp_path / "g.fa.fai").write_text("chr1\t200\t6\t200\t201\n")
    lines = [("gene", 21, 80, "+", "ID=g1;Name=F"), ("mRNA", 21, 80, "+", "ID=m1;Parent=g1"), ("CDS", 21, 50, "+", "Parent=m1"), ("CDS", 61, 80, "+", "Parent=m1"), ("gene", 101, 130, "-", "ID=g2;Name=R"), ("mRNA", 101, 130, "-", "ID=m2;Parent=g2"), ("CDS", 101, 130, "-", "Parent=m2")]
    (tmp_path / "a.gff").write_text("".join(f"chr1\tx\t{k}\t{a}\t{b}\t.\t{s}\t.\t{t}\n" for k, a, b, s, t in lines))
    other = {"A": "C", "C": "G", "G": "T", "T": "A"}
    bent = list(genome)
    for place in (65, 110):  # 1-based: base 35 of F, and base 21 of R
        bent[place - 1] = other[genome[place - 1]]
    reads = [(f"r{i}", 1, 0, 0, 0, [("M", 200)], "".join(bent)) for i in range(12)]
    spark.createDataFrame(reads, ALIGNED).write.parquet(str(tmp_path / "aligned"))
    (tmp_path / "s.json").write_text(json.dumps({"F": {"*2": [35]}, "R": {"*9": [3]}}))
    cli.main(["snv", "--alignments", str(tmp_path / "aligned"), "--contigs", str(tmp_path / "g.fa.fai"), "--reference", str(tmp_path / "g.fa"), "--gff", str(tmp_path / "a.gff"), "--genes", "F,R", "--stars", str(tmp_path / "s.json"), "--out", str(tmp_path / "v")])
    flip = dict(zip("ACGT", "TGCA"))
    want = {("F", "35", genome[64], bent[64], "1.0", "12"), ("R", "21", flip[genome[109]], flip[bent[109]], "1.0", "12")}
    assert set(_table(spark, tmp_path / "v" / "calls")) == want
    assert set(_table(spark, tmp_path / "v" / "depths")) == {("F", "12.0"), ("R", "12.0")}
    assert {r[:2] for r in _table(spark, tmp_path / "v" / "genotypes")} == {("F", "*2/*2"), ("R", "*1/*1")}


def test_adjusted_coverage_layout(spark):
    bins = spark.createDataFrame([("chr1", 0, 10, 1.23456, 0.4), ("chr1", 10, 20, 2.0, None), ("chr1", 20, 30, 2.0, float("nan"))], "chrom string, st int, en int, corrected double, gc double")
    assert [tuple(r) for r in sinks.gc_adjusted_table(bins).collect()] == [("chr1", 0, 10, "1.2346", "0.4000"), ("chr1", 10, 20, "2.0000", "NaN"), ("chr1", 20, 30, "2.0000", "NaN")]


def test_comment_lines_of_headers(spark):
    text = "@RG\tID:g\tDS:basecall_model=old runid=r1\tPU:f1\n@CO\tbasecaller:model=new\n@CO\trun_id=r2\n@CO\trun_id=r3 \n@CO\tsample_id=s"
    got = annotation.header_metadata(spark.createDataFrame([(text,), ("@HD\tVN:1",)], "h string"), "h").collect()
    assert (got[0].run_id, got[0].basecall_model, got[0].library_id, got[0].flow_cell_id) == ("r3", "new", "s", "f1")
    assert got[1].run_id is None and got[1].library_id is None


def test_first_transcript_in_the_file_wins_ties(spark):
    rows = [(i, "c", "s", *r) for i, r in enumerate([("gene", 1, 9, "+", "ID=g1;Name=G"), ("mRNA", 1, 9, "+", "ID=z;Parent=g1"), ("mRNA", 1, 9, "+", "ID=a;Parent=g1"), ("CDS", 1, 6, "+", "Parent=a"), ("CDS", 4, 9, "+", "Parent=z")])]
    gff = spark.createDataFrame(rows, "ord long, seqid string, source string, type string, start int, end int, strand string, attributes string")
    assert [tuple(r) for r in annotation.longest_cds(gff).collect()] == [("G", "z", 4, 9, "+")]
    assert [tuple(r) for r in annotation.longest_cds(gff.drop("ord")).collect()] == [("G", "a", 1, 6, "+")]


def test_last_region_of_a_name_counts(spark):
    reads = spark.createDataFrame([("a", 1, 0, 9, 0, [("M", 5), ("D", 5)], None), ("b", 1, -1, 9, 4, [("M", 9)], None)], ALIGNED)
    targets = spark.createDataFrame([(0, 0, 100, "A", 1), (0, 15, 25, "A", 2), (0, 7, 7, "E", 3), (1, 0, 9, "N", 4)], "ref_id int, st int, en int, nm string, ord int")
    assert {r.nm: r.depth for r in pileup.span_depth(reads, targets).collect()} == {"A": 0.5, "E": 0.0, "N": 0.0}
