import json
import xml.etree.ElementTree as ET

import pytest

from lociforge import __main__ as cli
from lociforge.sources import plots

ALIGNED = "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string"


@pytest.fixture
def files(spark, tmp_path):
    rows = [("a", 1, 0, 99, 0, [("M", 20)], "ACGTACGTACGTACGTACGT"), ("b", 1, 0, 109, 16, [("M", 20)], "G" * 20), ("c", 1, 1, 5, 256, [("M", 4)], "ACGT")]
    spark.createDataFrame(rows, ALIGNED).write.parquet(str(tmp_path / "aligned"))
    (tmp_path / "g.fai").write_text("chr1\t5000\t0\t60\t61\nchr2\t4000\t0\t60\t61\n")
    (tmp_path / "t.bed").write_text("chr1\t100\t110\tA\nchr2\t0\t9\tB\n")
    (tmp_path / "s.tsv").write_text("1\t112\tG\tA\n")
    return ["--alignments", str(tmp_path / "aligned"), "--contigs", str(tmp_path / "g.fai"), "--targets", str(tmp_path / "t.bed"), "--repeats", str(tmp_path / "t.bed"), "--sites", str(tmp_path / "s.tsv"), "--site-depth", "1"]


def test_tables(spark, files, tmp_path):
    read = lambda name: [tuple(r) for r in spark.read.csv(str(tmp_path / name), sep="\t", header=True).collect()]
    for name in cli.TABLES:
        assert cli.main([name, *files, "--out", str(tmp_path / name)]) == 0
    assert read("reads") == [("2",)]
    assert read("qc") == [("10", "1", "19")]
    assert read("maf") == [("0", "112", "G", "A", "1", "1")]
    with pytest.raises(Exception, match="already exists"):
        cli.main(["reads", *files, "--out", str(tmp_path / "reads")])


def test_result_and_report(files, tmp_path):
    result, page = str(tmp_path / "r.json"), str(tmp_path / "r.html")
    cli.main(["pipeline", *files, "--out", result, "--bin-width", "1000"])
    cli.main(["report", "--result", result, "--out", page])
    assert json.load(open(result))["qc"]["reads_aligned"] == 2 and "<h2>" in open(page).read()


def test_schema(capsys):
    cli.main(["schema"])
    assert json.loads(capsys.readouterr().out)["required"] == ["version", "timestamp"]


@pytest.mark.parametrize("lo, hi, want", [(0, 10, [0, 2, 4, 6, 8, 10]), (0, 1, [0, 0.2, 0.4, 0.6, 0.8, 1.0]), (3, 3, [3])])
def test_ticks(lo, hi, want):
    assert plots.ticks(lo, hi) == pytest.approx(want)


def test_figure():
    svg = plots.karyotype_figure([("1p", 5.0), ("1p", 6.0), ("1q", 7.0)], [("1p", 5.5), ("<x>", 1.0)], [("1p", 0.5, 0.4), ("9", 0, 0)])
    assert ET.fromstring(svg).tag.endswith("svg") and "polyline" in svg
    assert ET.fromstring(plots.figure([plots.Axes("a & b")])) is not None
