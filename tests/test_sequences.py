import random

from lociforge.operators import pileup

SCHEMA = "read_name string, aln_no int, ref_id int, pos0 int, flag int, cigar array<struct<op:string,len:int>>, seq string"


def _reads(rng, n=60):
    """Records with clips, insertions and deletions, and the bases that each puts at the reference's places (1-based; ``-`` deleted)."""
    rows, placed = [], []
    for i in range(n):
        pos0, at, seq, ops, bases = rng.randrange(80), 0, "", [("S", rng.randrange(4))], {}
        for _ in range(rng.randrange(1, 5)):
            ops += [(rng.choice("M=X"), rng.randrange(1, 30)), (rng.choice("IDN"), rng.randrange(1, 5))]
        for op, size in ops:
            letters = "".join(rng.choice("ACGT") for _ in range(size)) if op in "SM=XI" else "-" * size
            if op in "M=XD":
                bases |= {pos0 + 1 + at + k: letters[k] for k in range(size)}
            at += size if op in "M=XDN" else 0
            seq += letters if op in "SM=XI" else ""
        rows.append((f"r{i}", 1, 0, pos0, 0, ops, seq))
        placed.append(bases)
    return rows, placed


def test_alleles_of_stored_sequences(spark):
    rows, placed = _reads(random.Random(4))
    sites = [(0, p, "ACGT"[p % 4], "ACGT"[(p + 1) % 4]) for p in range(1, 160, 3)]
    got = pileup.site_allele_counts(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(sites, "ref_id int, pos int, al0 string, al1 string"), 1).collect()
    want = {(p, sum(b.get(p) == x for b in placed), sum(b.get(p) == y for b in placed)) for _, p, x, y in sites}
    assert {(r.pos, r.ref, r.alt) for r in got} == {w for w in want if w[1] + w[2]}


def test_coding_pileup_of_stored_sequences(spark):
    rows, placed = _reads(random.Random(5))
    cds = spark.createDataFrame([("F", 0, 20, 29, "+"), ("F", 0, 60, 64, "+"), ("R", 0, 40, 49, "-")], "gene string, ref_id int, st int, en int, strand string")
    got = pileup.cds_pileup(spark.createDataFrame(rows, SCHEMA), cds).collect()
    places = {"F": [*range(20, 30), *range(60, 65)], "R": [*range(49, 39, -1)]}
    turn = {"F": {}, "R": str.maketrans("ACGT", "TGCA")}
    want = [(g, i, f"r{k}", b[p].translate(turn[g])) for g, ps in places.items() for i, p in enumerate(ps) for k, b in enumerate(placed) if p in b]
    assert sorted((r.gene, r.cds_pos, r.read_name, r.base) for r in got) == sorted(want)


def test_records_without_sequence(spark):
    rows = [("a", 1, 0, 4, 0, [("M", 5)], ""), ("b", 1, 0, 4, 0, [("M", 5)], None)]
    cds = spark.createDataFrame([("F", 0, 6, 7, "+")], "gene string, ref_id int, st int, en int, strand string")
    assert {r.base for r in pileup.cds_pileup(spark.createDataFrame(rows, SCHEMA), cds).collect()} == {"N"}
