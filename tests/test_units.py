"""Unit vectors: hand-computed cases for functions and kernels."""

import gzip
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociforge.functions import cigar, dna
from lociforge.operators import annotation, intervals, karyotype, kernels
from lociforge.sources import bam, readers, report, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def ops(*pairs):
    return F.array(*[F.struct(F.lit(o).alias("op"), F.lit(n).alias("len")) for o, n in pairs])


@pytest.mark.parametrize("packed, want", [(10 << 4, ("M", 10)), (5 << 4 | 1, ("I", 5)), (100 << 4 | 4, ("S", 100))])
def test_cigar_decode(spark, packed, want):
    assert tuple(one(spark, cigar.decode(F.lit(packed)))) == want
    assert one(spark, cigar.encode(F.lit(want[0]), F.lit(want[1]))) == packed


def test_cigar_decode_rejects(spark):
    with pytest.raises(Exception, match="unknown CIGAR"):
        one(spark, cigar.decode(F.lit(10)))


@pytest.mark.parametrize("flag, parts, want", [(0, [("M", 100)], (0, 100, 1001, 1101, False)), (0, [("S", 10), ("M", 90)], (10, 100, 1001, 1091, False)), (16, [("M", 100)], (0, 100, 1001, 1101, True)), (16, [("S", 10), ("M", 90)], (0, 90, 1001, 1091, True))])
def test_query_coords(spark, flag, parts, want):
    assert tuple(one(spark, cigar.query_coords(F.lit(1000), ops(*parts), F.lit(flag)))) == want


def test_sequences(spark):
    assert one(spark, dna.reverse_complement(F.lit("GATTACA"))) == "TGTAATC"
    assert one(spark, dna.translate_codons(F.lit("ATGTAANNN"))) == "M* "


def test_alignment():
    assert kernels.align("ACGTACGT", "ACGTACGT") == (16, [("M", 8)])
    assert kernels.align("ACGT", "ACTT")[0] == 4
    assert kernels.align("ACGT", "ACGGT")[0] == 4
    assert kernels.align("AAACCCGGG", "AAAGGG") == (6, [("M", 3), ("D", 3), ("M", 3)])
    assert kernels.align("", "ACGT")[0] == -7 and kernels.align("", "") == (0, [])
    assert kernels.align("acgt", "ACGT")[0] == 8


def test_consensus():
    assert kernels.polish("AAACCC", ["AAACCC", "AAACCC", "AAAACCC"]) == "AAACCC"
    assert kernels.polish("AAACCC", ["AAAACCC", "AAAACCC", "AAACCC"]) == "AAAACCC"
    assert kernels.bracketed("AAAAA", "CCCCC", "BCR", "ABL1") == "AAAAA(BCR)|(ABL1)CCCCC"
    assert kernels.bracketed("AAAAA", "CCCCC", "PDGFRB", "EBF1", "GGG") == "AAAAA(PDGFRB)[GGG](EBF1)CCCCC"


def test_greedy_clusters():
    assert kernels.nearest_clusters([(100, 500), (120, 520), (149, 549), (160, 560)]) == [(100, 500, 3), (160, 560, 1)]


def test_levels_and_states():
    rng = np.random.default_rng(1)
    arms = {f"{c}{a}": rng.normal(150 if c < 4 else 100, 4, 60) for c in range(1, 20) for a in "pq"}
    levels = karyotype.find_levels(arms)
    assert [round(v, -1) for v, _ in levels[:2]] == [100, 150]
    states = karyotype.resolve_states(levels)
    cn = karyotype.assign({n: float(np.median(v)) for n, v in arms.items()}, states)
    assert {n for n, c in cn.items() if c == 3} == {f"{c}{a}" for c in (1, 2, 3) for a in "pq"}
    assert karyotype.resolve_states([]) == (1.0, 2.0, 3.0) and karyotype.resolve_states([(10.0, 5)]) == (5.0, 10.0, 15.0)


def test_karyotype_strings():
    diploid = {f"{c}{a}": 2 for c in range(1, 23) for a in "pq"} | {"X": 2}
    assert karyotype.karyotype_string(diploid) == "46XX; "
    assert "+7" in karyotype.karyotype_string(diploid | {"7p": 3, "7q": 3})
    assert karyotype.iscn_string({"7p": 3, "7q": 3, "9p": 1}) == "seq (9p)x1, (7)x3"


def test_interval_union(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 3, 9), (1, 9, 10), (1, 12, 13), (2, 0, 1)], "ref_id int, st int, en int")
    assert sorted(map(tuple, intervals.union_intervals(df).collect())) == [(1, 0, 10), (1, 12, 13), (2, 0, 1)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("# x\nchr1\t5\t9\tA\n\nchr2\t1\t2\n")
    assert sorted(map(tuple, readers.read_bed(spark, str(tmp_path / "a.bed")).collect())) == [("chr1", 5, 9, "A"), ("chr2", 1, 2, "chr2:1-2")]
    (tmp_path / "b.bed").write_text("chr1\t5\n")
    with pytest.raises(Exception, match="malformed BED"):
        readers.read_bed(spark, str(tmp_path / "b.bed")).collect()
    (tmp_path / "c.tsv").write_text("chromosome\tbin_start\tbin_end\tn_reads\tgc_content\nchr1\t0\t10\t5\tNA\nchr1\t10\t20\t5\tNaN\nchr1\t20\t30\t6\t0.5\n")
    assert [r.gc for r in readers.read_coverage(spark, str(tmp_path / "c.tsv")).orderBy("st").collect()] == [None, None, 0.5]


def test_longest_cds(spark):
    rows = [("c", "s", "gene", 1, 9, "+", "ID=g1;Name=G"), ("c", "s", "gene", 1, 9, "+", "ID=g10;Name=H"), ("c", "s", "mRNA", 1, 9, "+", "ID=r1;Parent=g1"), ("c", "s", "mRNA", 1, 9, "+", "ID=r2;Parent=g1"), ("c", "s", "CDS", 1, 6, "+", "Parent=r2,r9")]
    gff = spark.createDataFrame(rows, "seqid string, source string, type string, start int, end int, strand string, attributes string")
    assert [tuple(r) for r in annotation.longest_cds(gff).collect()] == [("G", "r2", 1, 6, "+")]
    assert annotation.longest_cds(gff, "r1").count() == 0


def test_bam_source(spark, tmp_path):
    def record(name, ref, pos, flag, cig, seq):
        packed = bytes(sum(("=ACMGRSVTWYHKDBN".index(c) << (4 if k == 0 else 0)) for k, c in enumerate(seq[i : i + 2])) for i in range(0, len(seq), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(cig), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for o, n in cig) + packed + b"\xff" * len(seq)
        return struct.pack("<i", len(body)) + body

    data = b"BAM\x01" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000) + record("r1", 0, 9, 0, [("M", 4)], "ACGT") + record("r1", 0, 99, 2048, [("S", 1), ("M", 2)], "ACG")
    (tmp_path / "s1.bam").write_bytes(gzip.compress(data[:40]) + gzip.compress(data[40:]))
    spark.dataSource.register(bam.BamDataSource)
    got = spark.read.format("bam").load(str(tmp_path / "s1.bam")).orderBy("aln_no").collect()
    assert [(r.sample_id, r.read_name, r.aln_no, r.pos0, r.seq) for r in got] == [("s1", "r1", 1, 9, "ACGT"), ("s1", "r1", 2, 99, "ACG")]
    assert [tuple(x) for x in got[1].cigar] == [("S", 1), ("M", 2)]
    assert bam.detect_format(b"CRAM") == "cram"


def test_result_document(tmp_path):
    doc = {"version": "1", "timestamp": "2024-01-01T00:00:00Z", "qc": {"nt_on_target": 5.0}}
    sinks.write_result(doc, str(tmp_path / "x" / "r.json"))
    with pytest.raises(FileExistsError):
        sinks.write_result(doc, str(tmp_path / "x" / "r.json"))
    assert sinks.validate({"bogus": True}) and not sinks.validate(doc)
    with pytest.raises(ValueError, match="fusions"):
        sinks.write_result(doc | {"fusions": [1]}, str(tmp_path / "y.json"))


def test_streaming_counts(spark, tmp_path):
    from lociforge.streaming.depth import stream_bin_counts

    spark.createDataFrame([(0, 5), (0, 15), (0, 17)], "ref_id int, pos0 int").write.parquet(str(tmp_path / "in"))
    q = stream_bin_counts(spark.readStream.schema("ref_id int, pos0 int").parquet(str(tmp_path / "in")), "counts", 10, str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("counts").collect())) == [(0, 0, 1), (0, 1, 2)]


def test_star_alleles():
    from lociforge.operators.genotype import star_alleles

    stars = {"*3A": [460, 719], "*3B": [460], "*2": [238]}
    calls = [(460, "G", "A", 0.5), (719, "A", "G", 0.5)]
    assert star_alleles(calls, {(460, 719): "alt/alt"}, stars) == ("*3A/*1", [])
    assert star_alleles(calls, {(460, 719): None}, stars) == ("*3B/*1", [719])
    assert star_alleles([(238, "G", "C", 0.95)], {}, stars) == ("*2/*2", [])
    assert star_alleles([(238, "G", "-", 0.95)], {}, stars) == ("*1/*1", [238])


def test_result_document_runs(spark):
    from lociforge.plans import pipeline
    from lociforge.sources.views import BIN, CONTIG_LENGTH, alignments, load
    from tests.conftest import SF

    inputs = pipeline.Inputs(alignments(spark, SF), load(spark, SF, "targets"), load(spark, SF, "repeats"), load(spark, SF, "sites"), CONTIG_LENGTH)
    doc = pipeline.result_document(spark, inputs, pipeline.Thresholds(bin_width=BIN, site_depth=1, fusion_reads=1))
    assert not sinks.validate(doc) and doc["qc"]["reads_aligned"] > 0 and doc["karyotype"]["karyotype"]
    assert doc["qc"]["target_coverage"] and all("deletions" in g for g in doc["cnv"]["genes"].values())
    assert "Digital karyotype: **" in report.markdown(doc)
