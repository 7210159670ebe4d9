import json

import pytest
from pyspark.sql import functions as F

from lociforge.sources import config, fasta, schema

SEQS = {"chr1": "ACGTacgtNN" * 13 + "AC", "chr2": "G", "chr3": "TTTTTGGGGG"}
WIDTH = 7


@pytest.fixture
def genome(tmp_path):
    text, index = "", ""
    for name, seq in SEQS.items():
        text += f">{name} described\n"
        index += f"{name}\t{len(seq)}\t{len(text)}\t{WIDTH}\t{WIDTH + 1}\n"
        text += "".join(seq[i : i + WIDTH] + "\n" for i in range(0, len(seq), WIDTH))
    (tmp_path / "g.fa").write_text(text)
    (tmp_path / "g.fa.fai").write_text(index)
    return str(tmp_path / "g.fa")


@pytest.mark.parametrize("chunk", [3, 10, 1000])
def test_fasta_chunks(spark, genome, chunk):
    got = {}
    for r in fasta.read_fasta(spark, genome, chunk).orderBy("contig", "chunk_no").collect():
        got[r.contig] = got.get(r.contig, "") + r.seq
    assert got == {k: v.upper() for k, v in SEQS.items()}


def test_regions_of_sequence(spark, genome):
    spans = [("chr1", 0, 1), ("chr1", 9, 31), ("chr1", 125, 500), ("chr1", 5, 5), ("chr2", 0, 4), ("none", 0, 4), ("chr1", 9, 31)]
    regions = spark.createDataFrame(spans, "contig string, st int, en int")
    got = fasta.region_sequences(fasta.read_fasta(spark, genome, 10), regions, 10).collect()
    assert sorted((r.contig, r.st, r.en, r.seq) for r in got) == sorted((c, s, e, SEQS.get(c, "").upper()[s:e]) for c, s, e in spans)


PANEL = {
    "genes": {
        "itd": {"A": {"chrom": "chr1", "start": 5, "end": 9, "label": "insertion"}},
        "fusions": {"special_margins": {"A": 70}, "skip_self_fusions": ["IG"], "blacklist_pairs": [["A", "B"]], "spike_in": {"gene1": "S", "gene2": "T"}, "one_sided_partners": {"A": ["P", "Q"]}},
    },
    "thresholds": {"fusions": {"default_margin": 100, "one_sided": {"min_breakpoint_reads": 4}}},
}


def test_panel_rules(spark):
    rules = config.read_fusion_rules(json.dumps(PANEL))
    pairs = spark.createDataFrame([("A", "B"), ("B", "A"), ("T", "S"), ("IGH", "xIG"), ("A", "")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = pairs.select(rules.is_blacklisted(a, b), rules.is_spike_in(a, b), rules.skips_self(a, b), rules.needed_reads(b == "")).collect()
    assert [tuple(r) for r in got] == [(True, False, False, 1), (True, False, False, 1), (False, True, False, 1), (False, False, True, 1), (False, False, False, 4)]
    assert rules.listed_partners() == {"P", "Q"}
    assert [r.margin for r in rules.margins(pairs, "a").collect()] == [70, 100, 100, 100, 70]


def test_insertions_of_both_layouts():
    want = {"A": config.Insertion("chr1", 5, 9, label="insertion")}
    assert config.read_insertions(json.dumps(PANEL)) == want == config.read_insertions(json.dumps(PANEL["genes"]["itd"]))


def test_genome():
    got = config.read_genome('{"name": "g", "centromeres": {"chr1": [3, 8]}, "par1": {}, "par2": {}}')
    assert got.centromeres == {"chr1": (3, 8)}
    with pytest.raises(KeyError):
        config.read_genome('{"name": "g"}')


def test_partner_bounds(spark):
    gff = spark.createDataFrame([("chr1", "gene", 1000, 2000, "ID=x; Name=P"), ("chr1", "mRNA", 1, 9, "Name=P"), ("chr1", "gene", 5000, 6000, "Name=P2")], "seqid string, type string, start int, end int, attributes string")
    bounds = config.gene_bounds(gff, ["P"])
    assert [tuple(r) for r in bounds.collect()] == [("P", "chr1", 1000, 2000)]
    points = spark.createDataFrame([("A", "chr1", 1500), ("A", "chr1", 900), ("A", "chr1", 2201), ("A", "chr2", 1500), ("B", "chr9", 1), (None, "chr9", 2)], "gene string, seqid string, pos int")
    got = config.near_listed(points, bounds, {"A": ["P", "absent"]}, 200).collect()
    assert sorted(r.pos for r in got) == [1, 2, 900, 1500]


@pytest.mark.parametrize(
    "document, wrong",
    [
        ({"version": "1", "timestamp": "t"}, 0),
        ({"bogus": True}, 3),
        ({"version": "1", "timestamp": "t", "karyotype": {"karyotype": {"1p": 2}, "blast_ratio": None}}, 0),
        ({"version": "1", "timestamp": "t", "karyotype": {"karyotype": {"1p": "2"}}}, 1),
        ({"version": "1", "timestamp": "t", "itd": {"genes": {"A": [{"position": 1, "size": 2}]}}}, 1),
    ],
)
def test_result_schema(document, wrong):
    assert len(schema.violations(document, schema.result_schema())) == wrong
