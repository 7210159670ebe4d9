import random
import re

import pytest
from pyspark.sql import functions as F

from lociforge.operators import karyotype, kernels, structural
from lociforge.plans.queries import CENTROMERES, ORACLES, PAR1, QUERIES, _found
from lociforge.sources.views import alignments, load
from tests.conftest import SF, rows_of


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_deldup_clusters_are_those_of_one_pass(spark):
    found = structural.deldup_candidates(structural.split_alignments(alignments(spark, SF)), max_overlap=100_000).toPandas()
    homes = {}
    for row in found.sort_values(["read_name", "aln_no0", "aln_no1"]).itertuples():
        mine = homes.setdefault((row.ref_id, row.kind), [])
        near = [(abs(c[0] - row.start) + abs(c[1] - row.end), i) for i, c in enumerate(mine) if abs(c[0] - row.start) < 50 and abs(c[1] - row.end) < 50]
        if near:
            mine[min(near)[1]][2] += 1
        else:
            mine.append([row.start, row.end, 1])
    want = sorted((*key, s - 1, e - 1, n) for key, mine in homes.items() for s, e, n in mine)
    assert sorted(tuple(r) for r in QUERIES["deldup_clusters"](spark, SF).collect()) == want and want


def test_near_deldup_candidates_meet(spark):
    rng = random.Random(2)
    rows = [(f"r{i:04}", 1, 2, 0, "del", at, at + 5000 + rng.randrange(60)) for i, at in enumerate(rng.choice([9_960, 30_000, 49_990]) + rng.randrange(120) for _ in range(600))]
    table = spark.createDataFrame(rows, "read_name string, aln_no0 int, aln_no1 int, ref_id int, kind string, start int, end int")
    want = sorted((0, "del", s - 1, e - 1, n) for s, e, n in kernels.nearest_clusters([r[5:] for r in rows]) if n >= 3)
    assert sorted(tuple(r) for r in structural.deldup_clusters(table).collect()) == want and sum(r[4] for r in want) > 500


def test_fusion_events_are_the_clusters_of_their_breakpoints(spark):
    points = structural.breakpoints(_found(spark, SF), min_anchor=100).toPandas()
    spans = {t.nm: (max(t.st - 5000, 0), t.en + 5000) for t in load(spark, SF, "targets").collect()}
    points["key"] = [(tuple(a), tuple(b)) for a, b in zip(points.g0, points.g1)]
    want = []
    for key, part in points.groupby("key"):
        for c in kernels.interval_clusters(part.sort_values(["read_name", "pos0", "pos1"]).to_dict("records")):
            middle = [sorted(c[name])[len(c[name]) // 2] for name in ("p0", "p1", "gaps")]
            sides = [spans[gene][0] < at < spans[gene][1] if gene else at // 10_000 == place for (_, place, gene), at in zip(key, middle)]
            if all(sides):
                want.append((*key, len(part), *middle[:2], c["dir0"], c["dir1"], c["n"], middle[2]))
    got = [(tuple(r.g0), tuple(r.g1), *r[2:]) for r in QUERIES["fusion_events"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and want


def test_alignments_rebuild_both_sequences(spark):
    for r in QUERIES["nw_align"](spark, SF).limit(3000).collect():
        ops = [(int(n), op) for n, op in re.findall(r"(\d+)(\D)", r.ops)]
        assert sum(n for n, op in ops if op in "M=XD") == len(r.ref) and sum(n for n, op in ops if op in "M=XI") == len(r.query)
        assert r.score >= 2 * len(r.query) - 2 * (3 + 3)  # both cuts as gaps: an optimum is never worse


def test_karyotype_queries_agree(spark):
    calls = QUERIES["karyotype_calls"](spark, SF).toPandas()
    levels = [r.level for r in QUERIES["karyotype_levels"](spark, SF).orderBy("rank").collect()]
    strings = QUERIES["karyotype_string"](spark, SF).collect()
    assert calls.segment.is_unique and len(calls) == load(spark, SF, "cov_bins").withColumn("a", _arm()).where("a is not null").select("a").distinct().count()
    assert levels and all(level > 0 for level in levels) and [(r.karyotype, r.iscn) for r in strings] == [(calls.karyotype[0], calls.iscn[0])]


def _arm():
    return karyotype.arm(F.col("chrom"), F.col("st"), F.col("en"), CENTROMERES, PAR1)


def test_range_joins_are_equi_joins(spark):
    plan = QUERIES["site_allele_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
