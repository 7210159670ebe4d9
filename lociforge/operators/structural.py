"""Split reads: pairs of alignments, fusions, deletions and duplications, copy numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociforge.functions import cigar
from lociforge.functions.stats import upper_median
from lociforge.operators import kernels, tiles
from lociforge.operators.intervals import bins, overlap_join
from lociforge.operators.pileup import sites_in, widened

LOCUS = 10_000
STEP = 4096
MARGIN, MIN_ANCHOR = 5000, 500


def split_alignments(alignments: DataFrame, reads: DataFrame | None = None) -> DataFrame:
    """Mapped records of non-duplex reads (no ``;`` in the name) with query coordinates and the number of records of their read.

    With ``reads`` (names, as ``pileup.hit_reads`` finds them) only theirs: a fusion needs a record at a target, so others need not be shuffled.
    """
    read = _query_records(alignments)
    if reads is not None:
        read = read.join(reads.select("read_name"), "read_name", "left_semi")
    return read.select("*", F.count("*").over(Window.partitionBy("read_name")).alias("parts"))


def _query_records(alignments: DataFrame) -> DataFrame:
    kept = alignments.where((F.col("ref_id") >= 0) & ~F.col("read_name").contains(";"))
    return kept.select("read_name", "aln_no", "ref_id", cigar.query_coords(F.col("pos0"), F.col("cigar"), F.col("flag")).alias("x")).select("read_name", "aln_no", "ref_id", "x.*")


def splits_at(alignments: DataFrame, targets: DataFrame, margin: int | Column = MARGIN, min_anchor: int = MIN_ANCHOR) -> DataFrame:
    """``split_alignments`` of the reads with a record at a target, each record with its first target (``_bin``, ``_nm``): one look at the targets, before records of a read meet."""
    met = tiles.first_targets(_query_records(alignments), widened(targets, margin), min_anchor)
    read = Window.partitionBy("read_name")
    return met.withColumns({"parts": F.count("*").over(read), "_hit": F.max(F.col("_bin").isNotNull()).over(read)}).where("_hit").drop("_hit")


def _as(df: DataFrame, tag: str) -> DataFrame:
    return df.select("read_name", *[F.col(c).alias(f"{c}{tag}") for c in df.columns if c != "read_name"])


def pairs(splits: DataFrame) -> DataFrame:
    """Each two records of a read, in order; columns carry 0 and 1."""
    many = splits.where("parts > 1")
    return _as(many, "0").join(_as(many, "1"), "read_name").where("aln_no0 < aln_no1")


def ambiguous(splits: DataFrame, targets: DataFrame, margin: int = MARGIN, min_anchor: int = MIN_ANCHOR) -> DataFrame:
    """Records of reads with three or more whose query range another record of the read covers from a different locus.

    Overlapping places are one locus, and so are two places within one widened target.
    """
    many = splits.where("parts > 2")
    both = _as(many, "0").join(_as(many, "1"), "read_name").where("aln_no0 <> aln_no1")
    same = F.expr("ref_id0 = ref_id1 and least(te0, te1) > greatest(ts0, ts1)")
    shared = F.expr("least(qe0, qe1) - greatest(qs0, qs1)")
    shorter = F.expr("least(qe0 - qs0, qe1 - qs1)")
    rivals = both.where(~same & (shared > F.floor(shorter / 2)) & (shared > min_anchor) & (shared > 0))
    # A widened target holds both places if it begins before the first one's end and ends after the last one's start: the furthest end among those that begin before is enough.
    order = Window.partitionBy("ref_id").orderBy("g_st")
    steps = widened(targets, margin).select("ref_id", "g_st", F.max("g_en").over(order).alias("reach"), F.lead("g_st").over(order).alias("next"))
    steps = steps.withColumn("past", F.least("reach", F.coalesce("next", "reach"))).where("g_st < past").withColumn("_t", F.explode(bins(F.col("g_st"), F.col("past") - 1, STEP)))
    first, last = F.least("te0", "te1") - 1, F.greatest("ts0", "ts1")
    held = (F.col("ref_id0") == F.col("ref_id")) & (F.floor(first / STEP).cast("int") == F.col("_t")) & (F.col("ref_id0") == F.col("ref_id1")) & (first >= F.col("g_st")) & (first < F.col("past")) & (last < F.col("reach"))
    return rivals.join(steps, held, "left_anti").select("read_name", F.col("aln_no0").alias("aln_no")).distinct()


def loci(splits: DataFrame, targets: DataFrame, margin: int | Column = MARGIN, min_anchor: int = MIN_ANCHOR) -> DataFrame:
    """Records with ``loci``: that of the first target they reach (which ``splits_at`` knows already), or every 10 kb bin they touch and one more, without a gene."""
    reached = splits if "_bin" in splits.columns else tiles.first_targets(splits, widened(targets, margin), min_anchor)
    touched = F.sequence(F.floor(F.col("ts") / LOCUS).cast("int"), F.floor(F.col("te") / LOCUS).cast("int") + 1)
    unnamed = F.transform(touched, lambda b: F.struct(F.col("ref_id").alias("ref_id"), b.alias("bin"), F.lit("").alias("gene")))
    named = F.array(F.struct(F.col("ref_id").alias("ref_id"), F.col("_bin").alias("bin"), F.col("_nm").alias("gene")))
    return reached.withColumn("loci", F.when(F.col("_bin").isNotNull(), named).otherwise(unnamed)).withColumn("gene", F.coalesce("_nm", F.lit(""))).drop("_bin", "_nm")


def locus_pairs(located: DataFrame, one_sided: list[str] | None = None, skip_self: tuple[str, ...] = ()) -> DataFrame:
    """(g0, g1) locus pairs of each read, ordered, with the pair of records that shows them first; ambiguous records are gone before.

    A pair needs a gene on one side; without one on the other, that gene must be in ``one_sided``.
    """
    both = pairs(located).where("gene0 <> '' or gene1 <> ''")
    known = F.when(F.col("gene0") == "", F.col("gene1")).otherwise(F.col("gene0"))
    allowed = F.expr("gene0 <> '' and gene1 <> ''") | (known.isin(*one_sided) if one_sided else F.lit(False))
    both = both.where(allowed)
    for part in skip_self:
        both = both.where(~(F.col("gene0").contains(part) & F.col("gene1").contains(part)))
    rows = both.withColumn("l0", F.explode("loci0")).withColumn("l1", F.explode("loci1")).where("l0 <> l1")
    turned = F.col("l0") > F.col("l1")
    sides = [F.when(turned, F.col(f"{c}1")).otherwise(F.col(f"{c}0")).alias(f"{c}_a") for c in ("ref_id", "qs", "qe", "ts", "te", "rev")]
    sides += [F.when(turned, F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(f"{c}_b") for c in ("ref_id", "qs", "qe", "ts", "te", "rev")]
    named = rows.select("read_name", "aln_no0", "aln_no1", F.least("l0", "l1").alias("g0"), F.greatest("l0", "l1").alias("g1"), *sides)
    evidence = F.min(F.struct("aln_no0", "aln_no1", *[c for c in named.columns if c.endswith(("_a", "_b"))]))
    return named.groupBy("g0", "g1", "read_name").agg(evidence.alias("x")).select("g0", "g1", "read_name", "x.*")


def locus_support(found: DataFrame, min_reads: int = 1) -> DataFrame:
    """Reads per locus pair, each once."""
    return found.groupBy("g0", "g1").agg(F.count("*").alias("reads")).where(F.col("reads") >= min_reads)


def breakpoints(found: DataFrame, min_anchor: int = MIN_ANCHOR) -> DataFrame:
    """Per read: both breakpoints with directions and the intervals that overlapping or missing query bases leave open."""
    late = F.col("qe_a") > F.col("qe_b")
    out = found.select(
        "g0", "g1", "read_name",
        F.when(late == F.col("rev_a"), F.col("te_a")).otherwise(F.col("ts_a")).alias("pos0"),
        F.when(late == F.col("rev_b"), F.col("ts_b")).otherwise(F.col("te_b")).alias("pos1"),
        F.when(late != F.col("rev_a"), "right").otherwise("left").alias("dir0"),
        F.when(late == F.col("rev_b"), "right").otherwise("left").alias("dir1"),
        F.expr("least(qe_a, qe_b) - greatest(qs_a, qs_b)").alias("overlap_gap"), F.expr("qe_a - qs_a").alias("len0"), F.expr("qe_b - qs_b").alias("len1"),
    )
    shared, missing = F.greatest("overlap_gap", F.lit(0)), F.greatest(-F.col("overlap_gap"), F.lit(0))
    out = out.where((F.col("len0") - shared >= min_anchor) & (F.col("len1") - shared >= min_anchor))
    for k in (0, 1):
        left, at = F.col(f"dir{k}") == "left", F.col(f"pos{k}")
        out = out.withColumn(f"lo{k}", F.greatest(at - F.when(left, shared).otherwise(missing), F.lit(0))).withColumn(f"hi{k}", at + F.when(left, missing).otherwise(shared))
    return out.drop("len0", "len1")


def fusion_events(points: DataFrame, targets: DataFrame, margin: int = MARGIN, min_reads: int = 3, min_breakpoint_reads: int = 1) -> DataFrame:
    """Clustered breakpoints of each well-supported locus pair, inside the widened genes, or the same bin for a side without one.

    Clustering is greedy in the order of read names; a locus pair's reads are one group (a pair of 10 kb loci, not a corpus).
    """
    locus = "struct<ref_id:int,bin:int,gene:string>"
    schema = f"g0 {locus}, g1 {locus}, supporting long, pos0 int, pos1 int, dir0 string, dir1 string, n_reads int, overlap_gap int"
    kept = ("read_name", "pos0", "pos1", "dir0", "dir1", "overlap_gap", "lo0", "hi0", "lo1", "hi1")

    def run(batches):
        for batch in batches:
            reads, ends = batch.column("reads"), batch.column("reads").offsets.to_numpy()
            values = reads.values.slice(ends[0], ends[-1] - ends[0])
            columns = {c: values.field(c).to_pylist() for c in kept[1:]}
            ends = ends - ends[0]
            out = []
            for k, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                if hi - lo == 1:  # most pairs of loci have one read
                    if min_breakpoint_reads <= 1:
                        out.append((k, 1, columns["pos0"][lo], columns["pos1"][lo], columns["dir0"][lo], columns["dir1"][lo], 1, columns["overlap_gap"][lo]))
                    continue
                rows = [{c: columns[c][i] for c in columns} for i in range(lo, hi)]
                out += [(k, hi - lo, kernels.upper_median(c["p0"]), kernels.upper_median(c["p1"]), c["dir0"], c["dir1"], c["n"], kernels.upper_median(c["gaps"])) for c in kernels.interval_clusters(rows) if c["n"] >= min_breakpoint_reads]
            at, *rest = zip(*out, strict=True) if out else [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("g0").take(take), batch.column("g1").take(take), *[pa.array(c, kind) for c, kind in zip(rest, kinds, strict=True)]], ["g0", "g1", "supporting", "pos0", "pos1", "dir0", "dir1", "n_reads", "overlap_gap"])

    grouped = points.groupBy("g0", "g1").agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("reads")).where(F.size("reads") >= min_reads)
    clustered = grouped.mapInArrow(run, schema)
    spans = targets.select(F.col("nm").alias("_nm"), F.greatest(F.col("st") - margin, F.lit(0)).alias("_st"), (F.col("en") + margin).alias("_en"))
    for k in (0, 1):
        at = F.col(f"pos{k}")
        inside = F.when(F.col(f"g{k}.gene") == "", F.floor(at / LOCUS) == F.col(f"g{k}.bin")).otherwise((at > F.col("_st")) & (at < F.col("_en")))
        clustered = clustered.join(spans, F.col(f"g{k}.gene") == F.col("_nm"), "left").where(inside).drop("_nm", "_st", "_en")
    return clustered


def drop_rare_one_sided(events: DataFrame, depths: DataFrame, min_fraction: float) -> DataFrame:
    """``events`` without those one-sided ones whose reads are fewer than ``min_fraction`` of their gene's depth (nm, depth); genes without depth keep theirs."""
    gene = F.when(F.col("g0.gene") == "", F.col("g1.gene")).otherwise(F.col("g0.gene"))
    one_sided = (F.col("g0.gene") == "") | (F.col("g1.gene") == "")
    known = depths.where("depth > 0").select(F.col("nm").alias("_nm"), F.col("depth").alias("_depth"))
    rare = one_sided & F.col("_depth").isNotNull() & (F.col("supporting") / F.col("_depth") < min_fraction)
    return events.join(known, gene == F.col("_nm"), "left").where(~F.coalesce(rare, F.lit(False))).drop("_nm", "_depth")


def near_partners(points: DataFrame, genes: DataFrame, margin: int = MARGIN) -> DataFrame:
    """Points (ref_id, pos) within the widened span of any gene, ends included."""
    return sites_in(points, genes.select("ref_id", F.greatest(F.col("st") - margin, F.lit(0)).alias("st"), (F.col("en") + margin).alias("en")))


def deldup_candidates(splits: DataFrame, min_anchor: int = MIN_ANCHOR, max_overlap: int = 100) -> DataFrame:
    """(read_name, kind, start, end): deletions and tandem duplications that two same-strand records of a read imply."""
    both = pairs(splits).where(f"ref_id0 = ref_id1 and rev0 = rev1 and least(qe0, qe1) - greatest(qs0, qs1) <= {max_overlap} and te0 - ts0 > {min_anchor} and te1 - ts1 > {min_anchor}")
    dup_a = F.expr("((not rev1 and qe0 < qe1) or (rev0 and qe1 < qe0)) and te0 - ts1 > 1000")
    dup_b = F.expr("((rev1 and qe0 < qe1) or (not rev0 and qe1 < qe0)) and te1 - ts0 > 1000")
    deletion = F.expr("((not rev0 and qe0 < qe1) or (rev0 and qe0 > qe1)) and te0 < ts1")
    row = lambda kind, s, e: F.struct(F.lit(kind).alias("kind"), F.col(s).alias("start"), F.col(e).alias("end"))
    found = F.when(dup_a, row("dup", "ts1", "te0")).when(dup_b, row("dup", "ts0", "te1")).when(deletion, row("del", "te0", "ts1"))
    return both.select("read_name", "aln_no0", "aln_no1", F.col("ref_id0").alias("ref_id"), found.alias("x")).where("x is not null").select("read_name", "aln_no0", "aln_no1", "ref_id", "x.*")


def _start_runs(candidates: DataFrame, margin: int, width: int = LOCUS, room: int = 64) -> DataFrame:
    """``candidates`` with ``_run``: whole runs of bins of starts that follow each other closer than ``margin``, by the ``room`` bins in which they begin.  Only a row per bin passes through the ordered window."""
    dealt = candidates.withColumn("_bin", F.floor(F.col("start") / width))
    edges = dealt.groupBy("ref_id", "kind", "_bin").agg(F.min("start").alias("_lo"), F.max("start").alias("_hi"))
    order = Window.partitionBy("ref_id", "kind").orderBy("_bin")
    apart = F.coalesce(F.col("_lo") - F.lag("_hi").over(order) >= margin, F.lit(True))
    runs = edges.select("ref_id", "kind", "_bin", F.when(apart, F.col("_bin")).alias("_begin")).withColumn("_run", F.floor(F.max("_begin").over(order) / room)).drop("_begin")
    return dealt.join(runs, ["ref_id", "kind", "_bin"]).drop("_bin")


def deldup_clusters(candidates: DataFrame, min_reads: int = 3, margin: int = 50) -> DataFrame:
    """Candidates of a contig and kind in clusters of ``min_reads`` reads or more, 0-based.

    Clustering is greedy in the order of read names.  Starts that lie ``margin`` or more apart never share a cluster, so a task takes whole runs of close starts and
    cuts them at every such gap; the result is that of a pass over the whole contig.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("start")
        start, end = frame.start.to_numpy(), frame.end.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(start) >= margin) + 1).tolist(), len(frame)]
        rows = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo == 1:
                rows += [(int(start[lo]) - 1, int(end[lo]) - 1, 1)] if min_reads <= 1 else []
                continue
            island = frame.iloc[lo:hi].sort_values(["read_name", "aln_no0", "aln_no1"])
            found = kernels.nearest_clusters(zip(island.start.tolist(), island.end.tolist(), strict=True), margin)
            rows += [(s - 1, e - 1, n) for s, e, n in found if n >= min_reads]
        out = pd.DataFrame(rows, columns=["start", "end", "reads"])
        out.insert(0, "kind", frame.kind.iloc[0])
        out.insert(0, "ref_id", frame.ref_id.iloc[0])
        return out

    return _start_runs(candidates, margin).groupBy("ref_id", "kind", "_run").applyInPandas(run, "ref_id int, kind string, start int, end int, reads int")


def gene_deldups(splits: DataFrame, genes: DataFrame, min_anchor: int = MIN_ANCHOR, min_reads: int = 3, around: int = 50_000) -> DataFrame:
    """(nm, ref_id, kind, start, end, reads): deletions and duplications at each gene (ref_id, st, en, nm), from records that meet it widened by ``around``.

    Every gene is clustered for itself, so a read near two of them counts for both.  Other records never reach the self-join.
    """
    number = genes.select("nm", F.col("ref_id").alias("_on"), "st", "en").withColumn("_g", F.row_number().over(Window.orderBy("nm", "_on", "st", "en")))  # a panel
    wide = number.select("_g", F.col("_on").alias("ref_id"), F.greatest(F.col("st") - around, F.lit(0)).alias("g_st"), (F.col("en") + around).alias("g_en"))
    near = overlap_join(splits.where("parts > 1"), wide, "ref_id", "ts", "te", "g_st", "g_en", 100_000).drop("g_st", "g_en")
    at_gene = near.withColumn("ref_id", F.col("_g")).drop("_g")  # only records of the same gene make a pair
    found = deldup_clusters(deldup_candidates(at_gene, min_anchor), min_reads).withColumnRenamed("ref_id", "_g")
    return found.join(number.select("_g", "nm", "_on"), "_g").select("nm", F.col("_on").alias("ref_id"), "kind", "start", "end", "reads")


def copy_ratio(depth: Column, baseline: Column, tumour: Column | None = None) -> Column:
    """Copies from a depth and the diploid one; with a tumour share, scaled to its cells; never negative."""
    plain = depth / baseline * 2
    if tumour is not None:
        delta = baseline * 0.5 * tumour
        plain = F.when(F.abs(delta) > 1e-6, (depth - baseline) / delta + 2).otherwise(plain)
    return F.greatest(plain, F.lit(0.0))


def focal_copies(depths: DataFrame, excluded: tuple[str, ...] = (), tumour: float | None = None, diploid: list[str] | None = None) -> DataFrame:
    """(nm, depth, focal): gene copies against the upper median of the diploid genes (null: all) but those whose name holds an excluded part.

    Where that leaves none, the baseline is that of all genes.
    """
    base = depths if diploid is None else depths.where(F.col("nm").isin(diploid))
    for part in excluded:
        base = base.where(~F.col("nm").contains(part))
    line = F.broadcast(base.agg(upper_median(F.col("depth")).alias("some")).join(depths.agg(upper_median(F.col("depth")).alias("every"))).select(F.coalesce("some", "every").alias("baseline")))  # one row
    return depths.join(line).select("nm", "depth", copy_ratio(F.col("depth"), F.col("baseline"), None if tumour is None else F.lit(tumour)).alias("focal"))


def local_copies(bins: DataFrame, genes: DataFrame, tumour: float | None = None, baseline: float | None = None) -> DataFrame:
    """(nm, depth, local): unweighted mean depth of the bins that a gene overlaps, against ``baseline`` (null: the upper median of covered bins)."""
    hits = overlap_join(bins.select("ref_id", "b_st", "b_en", "coverage"), genes.select("ref_id", "st", "en", "nm"), "ref_id", "b_st", "b_en", "st", "en", 1_000_000)
    per = hits.groupBy("nm").agg(F.avg("coverage").alias("depth"))
    middle = upper_median(F.col("coverage")) if baseline is None else F.lit(float(baseline))
    line = F.broadcast(bins.where("coverage > 0").agg(middle.alias("baseline")))  # one row
    return per.join(line).select("nm", "depth", copy_ratio(F.col("depth"), F.col("baseline"), None if tumour is None else F.lit(tumour)).alias("local"))


def align_pairs(rows: DataFrame, ref: str = "ref", query: str = "query") -> DataFrame:
    """``rows`` with the global alignment's score and operations."""

    def run(batches):
        for frame in batches:
            got = kernels.align_many([a or "" for a in frame[ref]], [b or "" for b in frame[query]])
            yield frame.assign(score=[g[0] for g in got], ops=["".join(f"{n}{op}" for op, n in g[1]) for g in got])

    return rows.mapInPandas(run, rows.schema.simpleString()[7:-1].replace(":", " ") + ", score int, ops string")


def consensus_reads(rows: DataFrame, group: str = "grp", seq: str = "seq", min_reads: int = 3) -> DataFrame:
    """(group, n_reads, consensus) of each group with enough reads; a group is one breakpoint's junction sequences, one row before the kernel takes a batch of groups."""
    batch = 2_000

    def run(frames):
        for frame in frames:
            for i in range(0, len(frame), batch):
                part = frame.iloc[i : i + batch]
                yield pd.DataFrame({group: part[group], "n_reads": [len(reads) for reads in part["reads"]], "consensus": kernels.consensus_many([list(reads) for reads in part["reads"]])})

    grouped = rows.groupBy(group).agg(F.sort_array(F.collect_list(seq)).alias("reads")).where(F.size("reads") >= max(min_reads, 0))
    return grouped.mapInPandas(run, f"{group} string, n_reads int, consensus string")
