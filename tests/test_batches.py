"""Kernels that take many groups at once against those that take one."""

import random

from pyspark.sql import functions as F

from lociforge.operators import kernels, structural


def _mutated(rng, seq, letters="ACGT"):
    out = [x for base in seq for x in rng.choice([[base]] * 12 + [[], [rng.choice(letters)], [base, rng.choice(letters)]])]
    return "".join(out)


def test_alignments_side_by_side_are_those_one_by_one():
    rng = random.Random(5)
    bases = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 7, 8, 32]))) for letters in ("ACGT", "AC", "ACgtN") for _ in range(300)]
    pairs = [(base, _mutated(rng, base)) for base in bases] + [("", ""), ("", "A"), ("A", ""), ("acgt", "ACGT"), ("é", "E")] + [("AAAAAAAA", "AAAAAA"[:n]) for n in range(7) for _ in range(40)]
    pairs += [("".join(rng.choice("AC") for _ in range(8)), "".join(rng.choice("AC") for _ in range(6))) for _ in range(500)]
    assert kernels.align_many([a for a, _ in pairs], [b for _, b in pairs]) == [kernels.align(*pair) for pair in pairs]


def test_consensus_of_many_groups_is_that_of_each(spark):
    rng = random.Random(6)
    bases = ["".join(rng.choice("ACGT") for _ in range(rng.choice([6, 12, 20]))) for _ in range(120)]
    groups = [sorted(rng.choice([base, _mutated(rng, base), _mutated(rng, base, "ACGTNa")]) for _ in range(rng.randrange(8))) for base in bases]
    assert kernels.consensus_many(groups) == [kernels.consensus(reads) for reads in groups]
    rows = [(f"g{i}", seq) for i, reads in enumerate(groups) for seq in [*reads, None]]
    got = structural.consensus_reads(spark.createDataFrame(rows, "grp string, seq string"))
    want = {f"g{i}": (len(reads), kernels.consensus(reads)) for i, reads in enumerate(groups) if len(reads) >= 3}
    assert {r.grp: (r.n_reads, r.consensus) for r in got.collect()} == want and want


def test_a_group_is_one_row_before_the_kernel(spark):
    rows = spark.range(600).select((F.col("id") / 3).cast("int").cast("string").alias("grp"), F.lit("ACGTACGT").alias("seq"))
    plan = structural.consensus_reads(rows)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and structural.consensus_reads(rows).count() == 200
