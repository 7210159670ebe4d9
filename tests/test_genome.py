"""Unequal contigs, contigs in an index's own order, file order of targets, diploid baselines, two karyotype passes."""

import numpy as np
import pandas as pd

from lociforge import __main__ as cli
from lociforge.operators import coverage, karyotype, structural
from lociforge.plans import pipeline


def test_contigs_have_their_own_length_and_name(spark, tmp_path):
    (tmp_path / "g.fai").write_text("chr1\t250\nchr10\t1000\nchr2\t990\nchrM\t100\nNC_060927.1\t500\nscaffold_7\t400\n")
    numbers, contigs = cli.contig_numbers(spark, str(tmp_path / "g.fai"))
    rows = {r.name: (r.ref_id, r.chrom, r.length) for r in contigs.collect()}
    assert numbers["chr2"] == 2 and rows["chr10"] == (1, "chr10", 1000) and rows["NC_060927.1"][1] == "chr3" and rows["scaffold_7"][1] is None
    reads = spark.createDataFrame([("a", 1, 0, 210, 0), ("b", 1, 0, 260, 0), ("c", 1, 1, 210, 0)], "read_name string, aln_no int, ref_id int, pos0 int, flag int")
    repeats = spark.createDataFrame([(0, 240, 900)], "ref_id int, st int, en int")
    depth = coverage.masked_bin_depth(reads, repeats, contigs, 100)
    assert {(r.ref_id, r.bin, r.reads, r.unmasked) for r in depth.collect()} == {(0, 2, 1, 40), (1, 2, 1, 100)}
    placed = pipeline.segments(depth, 100, {}, contigs)
    assert {(r.chrom, r.segment) for r in placed.collect()} == {("chr1", "1"), ("chr10", "10")}


def test_targets_keep_the_order_of_their_file(spark, tmp_path):
    (tmp_path / "t.bed").write_text("chr2\t500\t600\tlate\nchr1\t900\t990\tmiddle\nchr1\t10\t20\tfirst\n")
    rows = cli.regions(spark, str(tmp_path / "t.bed"), {"chr1": 0, "chr2": 1}).orderBy("ord").collect()
    assert [r.nm for r in rows] == ["late", "middle", "first"]


def test_copies_against_diploid_genes(spark):
    depths = spark.createDataFrame([("A", 10.0), ("B", 20.0), ("C", 40.0), ("D", 60.0)], "nm string, depth double")
    got = lambda **how: {r.nm: round(r.focal, 6) for r in structural.focal_copies(depths, **how).collect()}
    assert got(diploid=["A", "B"]) == {"A": 1.0, "B": 2.0, "C": 4.0, "D": 6.0}
    assert got(diploid=["none"]) == got() == {"A": 0.5, "B": 1.0, "C": 2.0, "D": 3.0}
    assert got(diploid=["B"], tumour=0.5)["A"] == 0.0 and got(diploid=["B"], tumour=0.5)["C"] == 6.0
    bins = spark.createDataFrame([(0, 0, 100, 30.0), (0, 100, 200, 50.0)], "ref_id int, b_st int, b_en int, coverage double")
    genes = spark.createDataFrame([(0, 50, 150, "A")], "ref_id int, st int, en int, nm string")
    assert [r.local for r in structural.local_copies(bins, genes, baseline=20.0).collect()] == [4.0]


def test_rare_one_sided_events_go(spark):
    side = "struct<ref_id:int,bin:int,gene:string>"
    events = spark.createDataFrame([((0, 1, ""), (1, 2, "A"), 3), ((0, 1, ""), (1, 2, "B"), 3), ((0, 1, "A"), (1, 2, "B"), 1), ((0, 3, "C"), (1, 2, ""), 1)], f"g0 {side}, g1 {side}, supporting long")
    depths = spark.createDataFrame([("A", 100.0), ("B", 10.0), ("C", 0.0)], "nm string, depth double")
    kept = structural.drop_rare_one_sided(events, depths, 0.1).collect()
    assert sorted((r.g0.gene, r.g1.gene) for r in kept) == [("", "B"), ("A", "B"), ("C", "")]


def _sample(rng, copies, slope):
    """Bins of all arms, their coverage falling with GC."""
    rows = []
    for chrom, n in copies.items():
        for k in range(60):
            gc = 0.3 + 0.3 * rng.random()
            rows.append(("s", chrom, k * 100, chrom, (50.0 * n + rng.normal(scale=1.5)) * (1 + slope * (gc - 0.41)), gc))
    return pd.DataFrame(rows, columns=["sample", "chrom", "st", "segment", "coverage", "gc"])


def test_two_passes_correct_gc(spark):
    copies = {str(c): 2 for c in range(1, 23)} | {"5": 3, "7": 1}
    bins = spark.createDataFrame(_sample(np.random.default_rng(3), copies, -0.8))
    for linear in (False, True):
        calls, corrected = karyotype.call_corrected(bins, linear=linear)
        assert {r.segment: r.cn for r in calls.select("segment", "cn").collect()} == copies
        spread = lambda df: df.where("segment = '1'").toPandas().coverage.std()
        assert spread(corrected) < 0.5 * spread(bins)


def test_allele_frequencies_decide_between_states(spark):
    """Two levels at a ratio of 1.5 are two and three copies; if the upper level alone has balanced alleles, one and two."""
    rng = np.random.default_rng(4)
    copies = {str(c): 2 if c > 8 else 3 for c in range(1, 23)}
    bins = spark.createDataFrame(_sample(rng, copies, 0.0))
    plain = {r.segment: r.cn for r in karyotype.call_karyotypes(bins).collect()}
    sites = [("s", str(c), float(v)) for c in range(1, 23) for v in (rng.normal(0.47, 0.01, 30) if c <= 8 else rng.normal(0.12, 0.01, 30))]
    told = {r.segment: r.cn for r in karyotype.call_karyotypes(bins, maf=spark.createDataFrame(sites, "sample string, segment string, maf double")).collect()}
    assert plain == copies and told == {s: n - 1 for s, n in copies.items()}
