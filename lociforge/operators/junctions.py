"""Sequences across fusion breakpoints: the reads that show one, their bases around it, and a consensus."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.functions import cigar, dna
from lociforge.functions.stats import upper_median
from lociforge.operators import kernels

FLANK, TOLERANCE, MIN_READS, INSERTED = 200, 30, 3, 0.5


def _side(records: DataFrame, events: DataFrame, k: int, tolerance: int) -> DataFrame:
    """Records whose edge towards side ``k`` of an event lies within the tolerance: an equi-join on contig, direction and a bin."""
    width = 2 * tolerance + 1
    at = F.col(f"pos{k}")
    near = events.select("event", F.col(f"ref{k}").alias("ref_id"), F.col(f"dir{k}").alias("dir"), at.alias("bp"), F.explode(F.array_distinct(F.array(F.floor((at - tolerance) / width), F.floor((at + tolerance) / width)))).alias("_bin"))
    ends = F.explode(F.array(F.struct(F.lit("right").alias("dir"), F.col("ts").alias("edge")), F.struct(F.lit("left").alias("dir"), F.col("te").alias("edge")))).alias("x")
    edges = records.select("*", ends).select(*records.columns, "x.*").withColumn("_bin", F.floor(F.col("edge") / width))
    hits = edges.join(near, ["ref_id", "dir", "_bin"]).where(F.abs(F.col("edge") - F.col("bp")) <= tolerance)
    q = F.when(F.col("dir") == "left", F.when(F.col("rev"), F.col("qs") - (F.col("bp") - F.col("te"))).otherwise(F.col("qe") + (F.col("bp") - F.col("te"))))
    q = q.otherwise(F.when(F.col("rev"), F.col("qe") - (F.col("bp") - F.col("ts"))).otherwise(F.col("qs") + (F.col("bp") - F.col("ts"))))
    first = (F.col("dir") == "left") != F.col("rev")  # the gene's bases come before the junction in the read
    hits = hits.withColumn("q", q).withColumn("first", first)
    hits = hits.withColumn("from", F.when(F.col("first"), F.col("qs")).otherwise(F.col("q"))).withColumn("to", F.when(F.col("first"), F.col("q")).otherwise(F.col("qe")))
    kept = ("aln_no", "flag", "rev", "q", "from", "to", "dir", "seq")
    return hits.select("event", "read_name", *[F.col(c).alias(f"{c}{k}") for c in kept])


def junction_sequences(alignments: DataFrame, events: DataFrame, flank: int = FLANK, tolerance: int = TOLERANCE) -> DataFrame:
    """(event, read_name, left, inserted, right, left_gene): a read's bases on either side of an event's junction and between.

    ``events``: event, ref0, pos0, dir0, ref1, pos1, dir1.  Both edges must lie within ``tolerance`` of the breakpoints.  Bases come from the primary record where
    just one is supplementary, else from the longer one, on the read's own strand; then they are turned so that the side of direction ``left`` is left.  A read counts once
    per event, by its first pair of records; duplex reads, junctions outside the sequence and records without one are left out.
    """
    mapped = alignments.where((F.col("ref_id") >= 0) & ~F.col("read_name").contains(";"))
    records = mapped.select("read_name", "aln_no", "ref_id", "flag", "seq", cigar.query_coords(F.col("pos0"), F.col("cigar"), F.col("flag")).alias("x")).select("read_name", "aln_no", "ref_id", "flag", "seq", "x.*")
    both = _side(records, events, 0, tolerance).join(_side(records, events, 1, tolerance), ["event", "read_name"]).where("aln_no0 <> aln_no1")
    extra = lambda k: F.col(f"flag{k}").bitwiseAND(2048) != 0
    size = lambda k: F.coalesce(F.length(f"seq{k}"), F.lit(0))
    of0 = F.when(extra(0) != extra(1), ~extra(0)).otherwise(size(0) >= size(1))
    pick = lambda a, b: F.when(F.col("of0"), F.col(a)).otherwise(F.col(b))
    read = both.withColumn("of0", of0).withColumn("s", F.when(pick("rev0", "rev1"), dna.reverse_complement(pick("seq0", "seq1"))).otherwise(F.upper(pick("seq0", "seq1"))))
    read = read.where((F.length("s") > 0) & F.col("q0").between(0, F.length("s")) & F.col("q1").between(0, F.length("s")))
    read = read.withColumn("ahead", F.col("from0") <= F.col("from1"))
    first, second = (lambda c: F.when(F.col("ahead"), F.col(f"{c}0")).otherwise(F.col(f"{c}1"))), (lambda c: F.when(F.col("ahead"), F.col(f"{c}1")).otherwise(F.col(f"{c}0")))
    start, end = F.greatest(first("from"), first("q") - flank), first("q")
    begin = F.greatest(second("q"), end)
    stop = F.least(second("to"), begin + flank)
    read = read.select("event", "read_name", "aln_no0", "aln_no1", "ahead", "dir0", _cut(start, end).alias("a"), _cut(end, begin).alias("m"), _cut(begin, stop).alias("b"))
    turn = F.col("ahead") != (F.col("dir0") == "left")
    flip = lambda c, other: F.when(turn, dna.reverse_complement(F.col(other))).otherwise(F.col(c))
    turned = read.select(
        "event", "read_name", "aln_no0", "aln_no1", flip("a", "b").alias("left"), flip("m", "m").alias("inserted"), flip("b", "a").alias("right"),
        F.when(F.col("ahead") != turn, 0).otherwise(1).alias("left_gene"),
    )
    one = F.min(F.struct("aln_no0", "aln_no1", "left", "inserted", "right", "left_gene")).alias("r")
    return turned.groupBy("event", "read_name").agg(one).select("event", "read_name", "r.left", "r.inserted", "r.right", "r.left_gene")


def _cut(start: Column, end: Column) -> Column:
    return F.col("s").substr((start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def junction_consensus(sequences: DataFrame, names: DataFrame, min_reads: int = MIN_READS, inserted_share: float = INSERTED) -> DataFrame:
    """(event, n_reads, consensus, bracketed, inserted) of each event with enough reads; ``names``: event, gene0, gene1.

    Left side, inserted bases and right side get a consensus each; bases are inserted only if at least ``inserted_share`` of the reads have some.  An event's reads
    are those of one breakpoint in one sample: one task.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        columns = ["event", "n_reads", "consensus", "bracketed", "inserted"]
        if len(frame) < min_reads:
            return pd.DataFrame(columns=columns)
        frame = frame.sort_values("read_name")
        part = lambda c: kernels.consensus([s for s in frame[c] if s])
        between = part("inserted") if (frame.inserted != "").mean() >= inserted_share else ""
        left, right, row = part("left"), part("right"), frame.iloc[0]
        genes = (row.gene0, row.gene1) if (frame.left_gene == 0).mean() >= 0.5 else (row.gene1, row.gene0)
        return pd.DataFrame([(row.event, len(frame), left + between + right, kernels.bracketed(left, right, *genes, between), between)], columns=columns)

    rows = sequences.join(names.select("event", "gene0", "gene1"), "event")  # called events of a panel
    return rows.groupBy("event").applyInPandas(run, "event string, n_reads int, consensus string, bracketed string, inserted string")


def junction_positions(sequences: DataFrame) -> DataFrame:
    """Per event: reads and the upper median of inserted lengths."""
    return sequences.groupBy("event").agg(F.count("*").alias("reads"), upper_median(F.length("inserted")).alias("inserted_length"))
