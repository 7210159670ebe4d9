"""CIGAR arithmetic as column expressions; ``cigar`` is array<struct<op: string, len: int>>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Operations in the order of their codes.
OPS = "MIDNSHP=X"
REFERENCE, QUERY, PAIRED = ("M", "D", "N", "=", "X"), ("M", "I", "S", "=", "X"), ("M", "=", "X")

UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 4, 16, 256, 2048
NOT_PRIMARY = UNMAPPED | SECONDARY | SUPPLEMENTARY


def total(cigar: Column, ops: tuple[str, ...]) -> Column:
    """Summed length of the operations named."""
    return F.aggregate(cigar, F.lit(0), lambda n, x: n + F.when(x["op"].isin(*ops), x["len"]).otherwise(0))


def span(cigar: Column) -> Column:
    """Reference bases that an alignment covers."""
    return total(cigar, REFERENCE)


def start1(pos0: Column) -> Column:
    """The 1-based start of an alignment stored 0-based."""
    return pos0 + 1


def encode(op: Column, length: Column) -> Column:
    """``length << 4 | code``; an operation without a code is an error."""
    code = F.call_function("instr", F.lit(OPS), op)
    return F.when(code > 0, F.shiftleft(length, 4).bitwiseOR(code - 1)).otherwise(F.raise_error(F.concat(F.lit("unknown CIGAR operation "), op)).cast("int"))


def decode(packed: Column) -> Column:
    """``struct<op, len>`` of a packed operation; codes from 10 on are an error (9 reads as a back step, ``B``)."""
    code = packed.bitwiseAND(F.lit(15))
    op = F.substring(F.lit(OPS + "B"), code + 1, F.lit(1))
    return F.struct(F.when(code < 10, op).otherwise(F.raise_error(F.concat(F.lit("unknown CIGAR code "), code.cast("string"))).cast("string")).alias("op"), F.shiftright(packed, 4).alias("len"))


def is_primary(flag: Column) -> Column:
    """Mapped, neither secondary nor supplementary."""
    return flag.bitwiseAND(F.lit(NOT_PRIMARY)) == 0


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(REVERSE)) != 0


def query_coords(pos0: Column, cigar: Column, flag: Column) -> Column:
    """``struct<qs, qe, ts, te, rev>``: the aligned part in query coordinates of the original strand, and on the reference (1-based start)."""
    lead = F.aggregate(
        cigar,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")),
        lambda s, x: F.struct((s["n"] + F.when(s["open"] & x["op"].isin("H", "S"), x["len"]).otherwise(0)).alias("n"), (s["open"] & x["op"].isin("H", "S")).alias("open")),
    )["n"]
    length, used = total(cigar, (*QUERY, "H")), total(cigar, ("M", "I", "=", "X"))
    rev, ts = is_reverse(flag), start1(pos0)
    qs, qe = lead, lead + used
    return F.struct(F.when(rev, length - qe).otherwise(qs).alias("qs"), F.when(rev, length - qs).otherwise(qe).alias("qe"), ts.alias("ts"), (ts + span(cigar)).alias("te"), rev.alias("rev"))


#: Operations placed by one running sum; longer CIGARs are placed piece by piece.
PIECE = 128


def _placed(cigar: Column, ops: tuple[str, ...]) -> Column:
    """``struct<t, q, out>`` of a CIGAR: reference and query bases used, and the operations of the kinds named with their offsets."""
    zero = F.struct(F.lit(0).alias("t"), F.lit(0).alias("q"), F.array().cast("array<struct<op:string,len:int,t:int,q:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        n = x["len"]
        row = F.struct(x["op"].alias("op"), n.alias("len"), s["t"].alias("t"), s["q"].alias("q"))
        return F.struct(
            (s["t"] + F.when(x["op"].isin(*REFERENCE), n).otherwise(0)).alias("t"),
            (s["q"] + F.when(x["op"].isin(*QUERY), n).otherwise(0)).alias("q"),
            F.when(x["op"].isin(*ops), F.concat(s["out"], F.array(row))).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(cigar, zero, step)


def placed_ops(cigar: Column, ops: tuple[str, ...]) -> Column:
    """The operations of the kinds named as array<struct<op, len, t, q>>, with offsets from the alignment's start.

    A running sum copies what it has gathered at every step, so a long CIGAR is cut into pieces whose sums are added afterwards: the work
    per operation is a piece and the number of pieces, not the whole array.
    """
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(cigar) - 1) / PIECE).cast("int")), lambda i: _placed(F.slice(cigar, i * PIECE + 1, F.lit(PIECE)), ops))
    zero = F.struct(F.lit(0).alias("t"), F.lit(0).alias("q"), F.array().cast("array<struct<t:int,q:int,out:array<struct<op:string,len:int,t:int,q:int>>>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.struct(s["t"].alias("t"), s["q"].alias("q"), x["out"].alias("out"))
        return F.struct((s["t"] + x["t"]).alias("t"), (s["q"] + x["q"]).alias("q"), F.concat(s["out"], F.array(piece)).alias("out"))

    def moved(piece: Column) -> Column:
        return F.transform(piece["out"], lambda x: F.struct(x["op"].alias("op"), x["len"].alias("len"), (x["t"] + piece["t"]).alias("t"), (x["q"] + piece["q"]).alias("q")))

    long = F.flatten(F.transform(F.aggregate(pieces, zero, step)["out"], moved))
    return F.when(F.size(cigar) <= PIECE, _placed(cigar, ops)["out"]).otherwise(long)


def op_intervals(alignments: DataFrame, ops: tuple[str, ...], *keep: str, seq: str | None = None) -> DataFrame:
    """A row per operation of the kinds named: ``keep`` columns, op, its length, reference start (1-based), end, and query offset.

    Running offsets come from prefix sums within the row's own array, so nothing is shuffled and bases are never exploded.
    With a ``seq`` column, ``bases`` is the operation's piece of it, cut before the rows are dealt out.
    """
    placed = placed_ops(F.col("cigar"), ops)
    if seq is not None:
        placed = F.transform(placed, lambda x: x.withField("bases", F.substring(F.col(seq), x["q"] + 1, x["len"])))
    rows = alignments.select(*keep, F.col("pos0").alias("_pos0"), F.explode(placed).alias("x"))
    start = F.col("_pos0") + 1 + F.col("x.t")
    end = start + F.when(F.col("x.op").isin(*REFERENCE), F.col("x.len")).otherwise(0)
    return rows.select(*keep, F.col("x.op").alias("op"), F.col("x.len").alias("len"), start.alias("t_start"), end.alias("t_end"), F.col("x.q").alias("q_start"), *([F.col("x.bases")] if seq is not None else []))
