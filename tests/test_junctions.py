import random

import pytest

from lociforge.operators import junctions
from lociforge.plans.pipeline import breakpoint_consensus

SCHEMA = "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string"
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def turned(s):
    return s[::-1].translate(COMPLEMENT)


@pytest.mark.parametrize("inserted", ["", "GATTACA"])
def test_junctions_of_both_strands(spark, inserted):
    rng = random.Random(7)
    a, b = ("".join(rng.choice("ACGT") for _ in range(300)) for _ in range(2))
    n, rows = len(inserted), []
    for i in range(4):
        read = a + inserted + b  # the left gene ends at 1300 (1-based end 1301), the right one starts at 5001
        if i % 2 == 0:
            rows += [(f"r{i}", 1, 0, 1000, 0, [("M", 300), ("S", n + 300)], read), (f"r{i}", 2, 1, 5000, 2048, [("H", 300 + n), ("M", 300)], b)]
        else:  # the read's own strand is the other one
            rows += [(f"r{i}", 1, 0, 1000, 16, [("M", 300), ("S", n + 300)], read), (f"r{i}", 2, 1, 5000, 2064, [("H", 300 + n), ("M", 300)], b)]
    rows += [("dup;lex", 1, 0, 1000, 0, [("M", 300), ("S", 300)], a + b), ("dup;lex", 2, 1, 5000, 2048, [("S", 300), ("M", 300)], a + b), ("far", 1, 0, 1040, 0, [("M", 300), ("S", 300)], a + b), ("far", 2, 1, 5000, 0, [("S", 300), ("M", 300)], a + b)]
    events = spark.createDataFrame([("e", 0, 1301, "left", 1, 5001, "right", "L", "R")], "event string, ref0 int, pos0 int, dir0 string, ref1 int, pos1 int, dir1 string, gene0 string, gene1 string")
    reads = spark.createDataFrame(rows, SCHEMA)
    found = junctions.junction_sequences(reads, events, flank=50)
    assert {(r.read_name, r.left, r.inserted, r.right, r.left_gene) for r in found.collect()} == {(f"r{i}", a[-50:], inserted, b[:50], 0) for i in range(4)}
    got = junctions.junction_consensus(found, events).collect()
    mark = f"(L)[{inserted}](R)" if inserted else "(L)|(R)"
    assert [(r.n_reads, r.consensus, r.bracketed) for r in got] == [(4, a[-50:] + inserted + b[:50], a[-50:] + mark + b[:50])]
    assert junctions.junction_consensus(found, events, min_reads=5).count() == 0


def test_named_in_the_other_order(spark):
    a, b = "ACGTTGCAAC" * 3, "TTGACCATGG" * 3
    rows = [("r", 1, 0, 1000, 0, [("M", 30), ("S", 30)], a + b), ("r", 2, 1, 5000, 2048, [("S", 30), ("M", 30)], None)]
    events = spark.createDataFrame([("e", 1, 5001, "right", 0, 1031, "left")], "event string, ref0 int, pos0 int, dir0 string, ref1 int, pos1 int, dir1 string")
    got = junctions.junction_sequences(spark.createDataFrame(rows, SCHEMA), events, flank=5).collect()
    assert [(r.left, r.inserted, r.right, r.left_gene) for r in got] == [(a[-5:], "", b[:5], 1)]


def test_consensus_of_called_fusions(spark):
    a, b = "ACGTTGCAAC" * 3, "TTGACCATGG" * 3
    rows = [x for i in range(3) for x in [(f"r{i}", 1, 0, 1000, 0, [("M", 30), ("S", 30)], a + b), (f"r{i}", 2, 1, 5000, 2048, [("S", 30), ("M", 30)], None)]]
    called = [{"g0": {"ref_id": 0, "gene": "L"}, "g1": {"ref_id": 1, "gene": ""}, "pos0": 1031, "pos1": 5001, "dir0": "left", "dir1": "right"}]
    reads = spark.createDataFrame(rows, SCHEMA)
    assert [(c["gene0"], c["bracketed"], c["n_reads"]) for c in breakpoint_consensus(reads, called, 3)] == [("L", f"{a}(L)|(){b}", 3)]
    assert breakpoint_consensus(reads, [], 3) == breakpoint_consensus(reads.drop("seq"), called, 3) == []
