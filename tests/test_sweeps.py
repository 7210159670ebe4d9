"""Records that meet targets in sweeps, phases by products, clusters by squares: against plain loops."""

import random
import time

from lociforge.operators import kernels, pileup, structural, tiles


def test_first_targets_and_bases_are_those_of_a_loop(spark):
    rng = random.Random(7)
    starts = [(rng.randrange(3), rng.choice([rng.randrange(400_000), rng.randrange(131_000, 132_000)])) for _ in range(400)]
    records = [(i, ref, ts, ts + rng.choice([0, 300, 501, 2_000, 140_000, 900_000])) for i, (ref, ts) in enumerate(starts)]
    targets = [(rng.randrange(2), st, st + rng.choice([100, 3_000, 60_000]), f"G{i % 30}", i // 2) for i, st in enumerate(rng.randrange(500_000) for _ in range(40))]
    table = pileup.widened(spark.createDataFrame(targets, "ref_id int, st int, en int, nm string, ord int"), 700)
    got = {r.i: (r._bin, r._nm) for r in tiles.first_targets(spark.createDataFrame(records, "i int, ref_id int, ts int, te int"), table, 500).collect()}
    first, bases = {}, {}
    for i, ref, ts, te in records:
        met = sorted((o, (st + (en - st) // 2) // 10_000, nm, st, en) for r, st, en, nm, o in targets if r == ref and ts < en + 700 and te > max(st - 700, 0))
        hits = [m for m in met if min(m[4] + 700, te) - max(m[3] - 700, 0, ts) > 500]
        first[i] = hits[0][1:3] if hits else (None, None)
        for o, _, nm, st, en in met:
            if not hits or o <= hits[0][0]:
                bases[nm] = bases.get(nm, 0) + max(min(en, te) - max(st, ts), 0)
    assert got == first and len(set(got.values())) > 10
    summed = {}
    for r in tiles.bases_up_to_first(spark.createDataFrame([r[1:] for r in records], "ref_id int, ts int, te int"), table, 500).collect():
        summed[r.nm] = summed.get(r.nm, 0) + r.bases
    assert summed == {nm: n for nm, n in bases.items() if n}


def test_phases_count_a_reads_last_record(spark):
    cigar = lambda n: [("M", n)]
    rows = [("r1", 0, 0, 9, cigar(8), "ACGTACGT"), ("r1", 1, 0, 9, cigar(4), "TCGT"), ("r2", 0, 0, 9, cigar(8), "TCGTACGA"), ("r3", 0, 0, 9, [("M", 3), ("D", 1), ("M", 4)], "ACGACGT"), ("r4", 0, 0, 15, cigar(2), "GT")]
    reads = spark.createDataFrame(rows, "read_name string, aln_no int, ref_id int, pos0 int, cigar array<struct<op: string, len: int>>, seq string")
    cds = spark.createDataFrame([("P", 0, 10, 12, "+"), ("P", 0, 13, 17, "+"), ("M", 0, 10, 17, "-")], "gene string, ref_id int, st int, en int, strand string")
    calls = spark.createDataFrame([("P", 1, "A", "T"), ("P", 4, "T", "-"), ("P", 8, "T", "A"), ("M", 1, "A", "T"), ("M", 8, "T", "A")], "gene string, pos int, ref string, alt string")
    got = {(r.gene, r.p1, r.p2): (r.cis, r.trans, r.phase) for r in pileup.phase(calls, reads, cds).collect()}
    assert got == {("P", 1, 4): (0, 3, "ref/alt"), ("P", 1, 8): (2, 1, None), ("P", 4, 8): (1, 2, None), ("M", 1, 8): (2, 1, None)}


def test_clusters_ask_only_founders_nearby():
    rng = random.Random(8)
    pairs = [(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(60_000)]
    start = time.process_time()
    found = kernels.nearest_clusters(pairs)
    assert sum(c[2] for c in found) == len(pairs) and time.process_time() - start < 20


def test_many_pairs_of_loci_are_one_batch(spark):
    locus = lambda gene, place: {"ref_id": 0, "bin": place, "gene": gene}
    rows = [(locus("A", 0), locus("", i), f"r{k}", 100 + 40 * k, i * 10_000 + 5, "left", "right", 0, 100 + 40 * k, 100 + 40 * k, i * 10_000 + 5, i * 10_000 + 5) for i in range(1, 40) for k in range(i % 3 + 1)]
    points = spark.createDataFrame(rows, "g0 struct<ref_id:int,bin:int,gene:string>, g1 struct<ref_id:int,bin:int,gene:string>, read_name string, pos0 int, pos1 int, dir0 string, dir1 string, overlap_gap int, lo0 int, hi0 int, lo1 int, hi1 int")
    targets = spark.createDataFrame([(0, 50, 900, "A", 0)], "ref_id int, st int, en int, nm string, ord int")
    events = structural.fusion_events(points, targets, min_reads=1)
    assert sorted((r.g1.bin, r.supporting, r.pos0, r.n_reads) for r in events.collect()) == sorted((i, i % 3 + 1, 100 + 40 * k, 1) for i in range(1, 40) for k in range(i % 3 + 1))
    assert "FlatMapGroups" not in events._jdf.queryExecution().executedPlan().toString()
