"""Result documents, the reports and cohort tables made of them, and what a panel changes."""

import json
import random

import pytest

from lociforge import __main__ as cli
from lociforge.operators import structural
from lociforge.plans import document, pipeline
from lociforge.sources import report, sinks

SIDE = lambda ref, place, gene: {"ref_id": ref, "bin": place, "gene": gene}
EVENT = {"g0": SIDE(0, 1, "A"), "g1": SIDE(22, 2, "B"), "supporting": 5, "pos0": 1_234_000, "pos1": 90, "dir0": "left", "dir1": "right", "n_reads": 4, "overlap_gap": -3}


def _full():
    events = [EVENT | {"pos0": 99, "n_reads": 1, "overlap_gap": 0}, EVENT, EVENT | {"g1": SIDE(0, 9, ""), "supporting": 3}, EVENT | {"g0": SIDE(1, 1, "S"), "g1": SIDE(1, 5, "T")}]
    calls = [{"segment": "1q", "cn": 2, "median": 3.0, "karyotype": "47,XX,+8", "iscn": "seq", "blast_ratio": 0.5}, {"segment": "1p", "cn": 3, "median": 4.5}]
    variants = [{"nm": "A", "ref_id": 0, "kind": "del", "start": 10, "end": 30, "reads": 4}, {"nm": "N", "ref_id": 0, "kind": "dup", "start": 1, "end": 5000, "reads": 3}]
    small = {
        "depths": [{"gene": "P", "depth": 12.0}, {"gene": "Q", "depth": None}], "genotypes": [{"gene": "P", "genotype": "*2/*1", "unassigned": [9]}], "changes": [{"gene": "P", "aa_changes": ["M1V"]}],
        "calls": [{"gene": "P", "pos": 9, "ref": "A", "alt": "G", "af": 0.456}, {"gene": "P", "pos": 3, "ref": "C", "alt": "T", "af": 0.5}], "phases": [{"gene": "P", "p1": 3, "p2": 9, "phase": None}],
    }
    return document.known(
        version="1", timestamp="t", metadata={"run_id": "r1"}, qc={"nt_on_target": 900.0, "reads_on_target": 8.0, "target_regions_nt": 30.0, "reads_aligned": 1234567}, fusions=document.fusions(events, spike_in=("T", "S")),
        karyotype=document.karyotype(calls, 7), cnv=document.copies([{"nm": "A", "focal": 1.25}], [{"nm": "A", "local": 2.5}, {"nm": "L", "local": None}], variants),
        snv=document.small_variants(small), itd=document.insertions([{"nm": "F", "pos": 7, "length": 21, "merged": 3, "coverage": 9}, {"nm": "F", "pos": 9, "length": 4, "merged": 5, "coverage": 5}], ["F", "U"]),
        breakpoint_consensus=document.consensus([{"gene0": "A", "ref0": 0, "pos0": 1, "gene1": "B", "ref1": 1, "pos1": 2, "consensus": "AC", "bracketed": "A(A)|(B)C", "inserted": "", "n_reads": 3}]),
    )


def test_sections_fit_the_schema(spark):
    doc = _full()
    assert sinks.validate(doc) == []
    found = doc["fusions"]["fusions"]
    assert [(f["gene1"]["name"], f["gene2"]["name"], f["supporting_reads"], [b["n_reads"] for b in f["breakpoints"]]) for f in found] == [("A", "", 3, [4]), ("A", "B", 5, [4, 1])]
    assert found[1]["gene1"] == {"name": "A", "chr": "chr1", "pos": 1_234_000} and found[1]["gene2"]["chr"] == "chrX" and [f["gene1"]["name"] for f in doc["fusions"]["spike_in"]] == ["S"]
    assert doc["cnv"]["genes"]["A"]["deletions"] == [{"chrom": "chr1", "start": 10, "end": 30, "reads": 4}] and doc["cnv"]["genes"]["L"] == {"deletions": [], "duplications": []} and len(doc["cnv"]["genes"]["N"]["duplications"]) == 1
    assert doc["snv"]["genes"]["P"]["mutations"] == {"3C>T": "0.50", "9A>G": "0.46"} and doc["snv"]["genes"]["P"]["unassigned_muts"] == ["A9>G (0.46)"] and doc["snv"]["genes"]["Q"]["genotype"] == ""
    assert [e["merged"] for e in doc["itd"]["genes"]["F"]] == [5, 3] and doc["itd"]["genes"]["U"] == [] and doc["karyotype"]["karyotype"] == {"1p": 3, "1q": 2}
    assert document.fusions([]) == {"fusions": []} and document.karyotype([]) is None and document.consensus([]) is None


def test_report_of_all_genes():
    text = report.markdown(_full(), figure="k.svg")
    for line in (
        "| A (chr1 ~1.23Mbp) | B (chrX ~0.00Mbp) | **5** | chr1:1234000<< -- chrX:90>>  (4 reads [3bp ins]); chr1:99<< -- chrX:90>>  (1 reads) |", "Blast ratio (tumor fraction): **50.00%**", "![Karyotype](k.svg)",
        "Local read-depth based copy number estimate: **3x (2.5x)**", "chr1: 10 - 30 (20 nt): **4 supporting reads**", "21 nt insertion at position 7: 3 reads (of 9); 0.50 AR", "4 nt insertion at position 9: 5 reads (of 5); 1.00 AR",
        "- 9A>G: 0.46 AF", "- M1V", "Genotype: **\\*2/*1**".replace("\\", ""), "- Genome-wide reads aligned: **1,234,567**", "- Mean on-target read length: **112 nt**", "- Mean coverage over target regions: **30.00x**", "**Run ID:** r1",
    ):
        assert line in text.splitlines(), line
    page = report.html(text)
    assert page.count("<table>") == page.count("</table>") == 2 and page.count("<ul>") == page.count("</ul>") and '<img alt="Karyotype" src="k.svg">' in page and "<b>47,XX,+8</b>" in page and "&gt;G" in page
    empty = report.markdown({"version": "1", "timestamp": "t"})
    assert "**No fusions detected**" in empty and "Not run" in empty and "**None detected**" in empty
    assert "A|B" in report.html("\n".join(report._table(("x",), [("A|B",)])))


PANEL = {
    "genes": {
        "cnv": {"focal_genes": ["L", "A", "Z"], "local_cn_genes": ["L"], "deletion_genes": ["A", "Z"], "duplication_genes": ["A"], "exclude_from_baseline": ["A"]},
        "itd": {"U": {"chrom": "chr1", "start": 20_000, "end": 21_000, "label": "insertion", "min_frequency": 0.05}},
        "snv": {"pharmacogenomics": ["P"], "pathogenic": ["X"], "transcripts": {"P": {"transcript": "m1", "variants": {"*2": [3]}}, "W": {"variants": {"w": [1]}}}},
        "fusions": {"special_margins": {"A": 7000}, "blacklist_pairs": [["B", "A"]], "one_sided_genes": ["A"], "one_sided_partners": {"A": ["Y", "D"]}, "skip_self_fusions": ["K"]},
    },
    "thresholds": {"fusions": {"min_supporting_reads": 3, "min_breakpoint_reads": 2, "one_sided": {"min_fraction": 0.01}}},
}


def test_report_of_a_panel(tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PANEL))
    panel = cli.read_panel(str(tmp_path / "p.json"))
    assert [f["gene2"]["name"] for f in report.shown_fusions(_full(), panel)] == [""]
    lines = report.markdown(_full(), panel, ["B", "A", "B"]).splitlines()
    heads = [x[4:] for x in lines if x.startswith("### ")]
    assert heads == ["Rearrangements with only one side in the panel", "L", "A intragenic deletions", "Z intragenic deletions", "A intragenic tandem duplications", "U insertion", "Disease variants", "Pharmacogenomic variants"]
    assert lines.count("Not tested") == 2 and "- P (m1): *2" in lines and "- W: w" in lines and "- A (partners: D, Y)" in lines and "**Target genes:** A, B" in lines and "Focal genes: A, L, Z" in lines


def test_cohort_command(spark, tmp_path):
    (tmp_path / "s1.json").write_text(json.dumps(_full()))
    (tmp_path / "s2.json").write_text(json.dumps({"version": "1", "timestamp": "t"}))
    how = {"itd_genes": {"F": "ITD"}, "cnv_genes": ["A"], "local_cn_genes": ["L"], "deletion_genes": ["A"], "duplication_genes": ["N"], "snv_genes": ["P"]}
    (tmp_path / "c" / "x").mkdir(parents=True)
    (tmp_path / "c" / "how.json").write_text(json.dumps(how))
    (tmp_path / "c" / "few.json").write_text(json.dumps({"columns": ["sample", "karyotype", "unknown"], "fusion_blacklist": [["A", "B"]]}))
    cli.main(["cohort", "--results", str(tmp_path / "*.json"), "--out", str(tmp_path / "t"), "--config", str(tmp_path / "c" / "how.json")])
    one, two = (r.asDict() for r in spark.read.csv(str(tmp_path / "t"), sep="\t", header=True, escape='"').collect())
    assert set(two.values()) == {"s2", "MISSING"}
    assert one["fusions"] == "A (chr1 ~1.23Mbp) :: B (chrX ~0.00Mbp) (5 reads)" and one["spike_in"].startswith("S (chr2 ") and one["one_sided_fusions"].startswith("A (chr1 ~1.23Mbp) :: ")
    want = {"karyotype": "47,XX,+8", "ISCN": "seq", "warnings": "MISSING", "reads_aligned": "1234567", "on_target_read_length": "112", "on_target_depth": "30.00", "seq_ID": "r1", "seq_date": "MISSING", "A": "1x (1.3x)", "L": "MISSING"}
    want |= {"A_deletions": "chr1: 10 - 30 (20 nt): 4 supporting reads", "N_ITD": "chr1: 1 - 5000 (4999 nt): 3 supporting reads", "P_depth": "12.00", "P_mutations": "3C>T: 0.50 AF; 9A>G: 0.46 AF", "P_genotype": "*2/*1"}
    assert {k: one[k] for k in want} == want and one["F_ITD"].split("; ")[0] == "4 nt insertion at position 9: 5 reads (of 5)"
    cli.main(["cohort", "--results", str(tmp_path / "*.json"), "--out", str(tmp_path / "f"), "--config", str(tmp_path / "c" / "few.json")])
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "f"), sep="\t", header=True).collect()] == [("s1", "47,XX,+8", "MISSING"), ("s2", "MISSING", "MISSING")]


def test_summary():
    text = sinks.summary(_full())
    assert "A :: B (5 reads)" in text and "A :: ? (3 reads)" in text and "genotype P: *2/*1" in text and "deletions and duplications: 2" in text and "not called" in sinks.summary({})


def test_deletions_of_each_gene(spark):
    """A gene's variants are those of the reads that meet it, clustered for it alone."""
    rows = []
    for i in range(8):  # a deletion in A and near B; its ends wobble
        rows += [(f"d{i}", 1, 0, 0, 1500, 40_000, 41_500 + i, False, 2), (f"d{i}", 2, 0, 1500, 3000, 60_000 + i, 61_500, False, 2)]
    for i in range(4):  # far from all genes, and on another contig
        rows += [(f"f{i}", 1, 0, 0, 1500, 900_000, 901_500, False, 2), (f"f{i}", 2, 0, 1500, 3000, 960_000, 961_500, False, 2)]
        rows += [(f"g{i}", 1, 1, 0, 1500, 40_000, 41_500, False, 2), (f"g{i}", 2, 1, 1500, 3000, 60_000, 61_500, False, 2)]
    splits = spark.createDataFrame(rows, "read_name string, aln_no int, ref_id int, qs int, qe int, ts int, te int, rev boolean, parts int")
    genes = spark.createDataFrame([(0, 45_000, 50_000, "A"), (0, 105_000, 120_000, "B"), (0, 300_000, 301_000, "C")], "ref_id int, st int, en int, nm string")
    got = {(r.nm, r.ref_id, r.kind, r.start, r.end): r.reads for r in structural.gene_deldups(splits, genes).collect()}
    assert got == {("A", 0, "del", 41_499, 59_999): 8}


def test_pipeline_with_a_panel(spark, tmp_path):
    """Reads that join A and D, a listed partner that is no target, and a star allele in P; joins to a place that is not listed go."""
    rng = random.Random(3)
    genome = "".join(rng.choice("ACGT") for _ in range(60_000))
    (tmp_path / "g.fa").write_text(f">chr1\n{genome}\n>chr2\n{genome}\n")
    (tmp_path / "g.fa.fai").write_text("chr1\t60000\t6\t60000\t60001\nchr2\t60000\t60013\t60000\t60001\n")
    lines = [("chr1", "gene", 41, 100, "ID=g1;Name=P"), ("chr1", "mRNA", 41, 100, "ID=m1;Parent=g1"), ("chr1", "CDS", 41, 100, "Parent=m1"), ("chr2", "gene", 30_000, 32_000, "ID=g2;Name=D")]
    (tmp_path / "a.gff").write_text("".join(f"{c}\tx\t{k}\t{a}\t{b}\t.\t+\t.\t{t}\n" for c, k, a, b, t in lines))
    (tmp_path / "t.bed").write_text("chr1\t10000\t12000\tA\nchr1\t50\t90\tP\n")
    (tmp_path / "p.json").write_text(json.dumps(PANEL))
    bent = genome[:42] + ("A" if genome[42] != "A" else "C") + genome[43:]
    aligned = [(f"p{i}", 1, 0, 0, 0, [("M", 200)], bent[:200]) for i in range(12)]
    for i in range(6):  # chr1:11000-12500, then chr2 at 30,000 (listed) or 50,000 (not)
        for name, at in (("y", 30_000), ("n", 50_000)):
            query = genome[11_000:12_500] + genome[at : at + 1500]
            aligned += [(f"{name}{i}", 1, 0, 11_000, 0, [("M", 1500), ("S", 1500)], query), (f"{name}{i}", 2, 1, at, 2048, [("S", 1500), ("M", 1500)], query)]
    spark.createDataFrame(aligned, "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string").write.parquet(str(tmp_path / "aligned"))
    given = {"alignments": "aligned", "contigs": "g.fa.fai", "targets": "t.bed", "panel": "p.json", "gff": "a.gff", "reference": "g.fa", "out": "r.json"}
    cli.main(["pipeline", *[x for k, v in given.items() for x in (f"--{k}", str(tmp_path / v))], "--bin-width", "10000"])
    doc = json.loads((tmp_path / "r.json").read_text())
    found = doc["fusions"]["fusions"]
    assert found and {(f["gene1"]["name"], f["gene2"]["name"], f["gene2"]["chr"]) for f in found} == {("A", "", "chr2")}
    assert all(f["supporting_reads"] == 6 and abs(f["gene2"]["pos"] - 30_000) < 2 for f in found)
    assert doc["snv"]["genes"]["P"]["genotype"] == "*2/*2" and list(doc["snv"]["genes"]["P"]["mutations"].values()) == ["1.00"]
    assert doc["itd"]["genes"] == {"U": []} and doc["qc"]["target_coverage"]["P"] == 12.0
    cli.main(["report", "--result", str(tmp_path / "r.json"), "--out", str(tmp_path / "r.html"), "--panel", str(tmp_path / "p.json"), "--targets", str(tmp_path / "t.bed")])
    assert "Target genes" in (tmp_path / "r.html").read_text()


@pytest.mark.parametrize("value, want", [(2.5, "3x (2.5x)"), (0.4, "0x (0.4x)"), (1.49, "1x (1.5x)")])
def test_copies_are_rounded_to_whole_ones(value, want):
    assert want in report._copies("x", value)


def test_regions_have_their_own_limits(spark):
    rows = [(f"r{i}", 1, 0, 0, 0, [("M", 30), ("I", 3 if i < 6 else 8), ("M", 30)], None) for i in range(12)] + [(f"s{i}", 1, 0, 200, 0, [("M", 30), ("I", 3), ("M", 30)], None) for i in range(6)]
    reads = spark.createDataFrame(rows, "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string")
    regions = spark.createDataFrame([(0, 0, 100, "A", 1), (0, 200, 300, "B", 2)], "ref_id int, st int, en int, nm string, ord int")
    given = lambda **limits: pipeline.Inputs(reads, regions, regions, regions, 1000, regions, insertion_limits=limits)
    lengths = lambda inputs: sorted((r.nm, r.length) for r in pipeline.insertion_calls(inputs).collect())
    assert lengths(given()) == [("A", 8)]
    assert lengths(given(A=(3, 0.0))) == [("A", 3), ("A", 8)]
    assert lengths(given(A=(9, 0.0), B=(3, 0.0))) == [("B", 3)]
