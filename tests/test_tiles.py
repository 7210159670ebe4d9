"""Counts by tile against rows per base, and insertions by place against those by name."""

import random

import pytest
from pyspark.sql import functions as F

from lociforge.functions import cigar
from lociforge.operators import pileup, tiles

CIGAR = "cigar array<struct<op: string, len: int>>"


def _reads(spark, n, unit, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lens = [("S", rng.randrange(9)), ("M", rng.randrange(1, 90)), ("D", rng.randrange(1, 9)), ("=", rng.randrange(1, 40)), ("I", rng.choice([3, 6, 6, 7, 20])), ("X", rng.randrange(1, 9)), ("P", 3), ("N", rng.randrange(1, 70)), ("M", 12)]
        used = sum(size for op, size in lens if op in "MIS=X")
        bases = "".join(rng.choice("ACGTN") for _ in range(rng.choice([1, 5, 32]) if unit else used))
        rows.append((f"r{i // 3}", i % 3, rng.randrange(-1, 2), rng.choice([rng.randrange(900), rng.randrange(40, 44)]), 0, lens, rng.choice([bases] * 9 + [None, ""])))
    return spark.createDataFrame(rows, f"read_name string, aln_no int, ref_id int, pos0 int, flag int, {CIGAR}, {'seq32' if unit else 'seq'} string")


CDS = [("A", 0, 0, 10, 99, "+"), ("A", 0, 1, 300, 389, "+"), ("B", 0, 0, 50, 139, "-"), ("B", 0, 1, 600, 610, "-"), ("C", 1, 0, 1, 1000, "+"), ("D", 1, 0, 40, 42, "+"), ("D", 1, 1, 50, 55, "-")]


@pytest.mark.parametrize(("unit", "width"), [(True, tiles.TILE), (False, 512)])
def test_coding_counts_are_those_of_a_row_per_base(spark, unit, width):
    reads = _reads(spark, 300, unit)
    cds = spark.createDataFrame(CDS, "gene string, ref_id int, exon int, st int, en int, strand string")
    want = pileup.pileup_counts(pileup.cds_pileup(reads, cds))
    got = pileup.cds_counts(reads, cds, width)
    rows = lambda df: sorted(map(tuple, df.select(*want.columns).collect()))
    found = rows(got)
    assert found == rows(want) and len(found) > 500


@pytest.mark.parametrize("unit", [True, False])
def test_site_counts_are_those_of_a_row_per_base(spark, unit):
    reads = _reads(spark, 300, unit, 2)
    sites = spark.createDataFrame([(c, p, a, b) for c in (0, 1) for p in range(0, 900, 7) for a, b in (("A", "C"), ("N", None), ("GG", "T"), ("C", "C"))] + [(0, 7, "A", "C")] * 2, "ref_id int, pos int, al0 string, al1 string")
    ops = pileup._ops_with_bases(reads, ("M", "=", "X"), "ref_id").withColumnRenamed("ref_id", "r")
    hits = sites.join(ops, (F.col("ref_id") == F.col("r")) & (F.col("pos") >= F.col("t_start")) & (F.col("pos") < F.col("t_end"))).withColumn("base", pileup.base_at(F.col("bases"), F.col("q_start") + F.col("pos") - F.col("t_start")))
    want = hits.groupBy("ref_id", "pos", "al0", "al1").agg(F.count_if(F.col("base") == F.col("al0")).alias("ref"), F.count_if(F.col("base") == F.col("al1")).alias("alt")).where("ref + alt >= 1")
    got = pileup.site_allele_counts(reads, sites, 1, 512)
    found = sorted(map(str, got.collect()))
    assert found == sorted(map(str, want.collect())) and len(found) > 100


def test_insertions_by_place_are_those_of_each_region(spark):
    reads = _reads(spark, 500, False, 3)
    regions = [(0, 40, 130, "A"), (0, 100, 400, "B"), (1, 0, 1000, "D"), (1, 100, 100, "G")]
    ops = cigar.op_intervals(reads.where("ref_id >= 0"), ("I", "D", "N", "P"), "ref_id").collect()
    want = {}
    for o in ops:
        for ref, st, en, name in regions:
            if o.ref_id == ref and o.t_start <= en and max(o.t_end, o.t_start + 1) > st and (o.op != "I" or o.t_start < en):
                key = name, o.t_start, o.len if o.op == "I" else -o.len
                want[key] = want.get(key, 0) + 1
    table = spark.createDataFrame(regions, "ref_id int, st int, en int, nm string")
    assert {(r.nm, r.pos, r.length): r.n for r in pileup.insertions(reads, table).collect()} == want
    events = {k: n for k, n in want.items() if k[2] >= 4 and n > 1}
    more = lambda v: sum(n for c, n in want.items() if c[0] == v[0] and c != v and abs(c[1] - v[1]) < int(v[2] * 1.1) and c[2] * 0.9 < v[2] < c[2] * 1.1)
    found = {(r.nm, r.pos, r.length): r.merged for r in pileup._duplications_by_place(reads, table, 4).collect()}
    assert found == {v: n + more(v) for v, n in events.items()} and len(found) > 10


def test_the_panel_is_asked_by_tile(spark):
    reads = _reads(spark, 200, False, 4)
    places = spark.createDataFrame([(0, 40, 45), (0, 44, 60), (0, 500, 510), (0, 512, 520), (1, 950, 960)], "ref_id int, st int, en int")
    spans = reads.where("ref_id >= 0").select("read_name", "aln_no", "ref_id", "pos0", F.expr("pos0 + 1 + aggregate(cigar, 0, (n, x) -> n + if(x.op in ('M', 'D', 'N', '=', 'X'), x.len, 0))").alias("te")).collect()
    want = sorted((s.read_name, s.aln_no) for s in spans if any(s.ref_id == p.ref_id and s.pos0 < p.en and s.te >= p.st for p in places.collect()))
    found = pileup.records_at(reads, places, 64)
    assert sorted((r.read_name, r.aln_no) for r in found.collect()) == want and 0 < len(want) < len(spans)
