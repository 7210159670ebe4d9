"""Pileups: allele counts at sites, on-target quality, focal depth, coding-sequence pileups and insertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociforge.functions import cigar
from lociforge.operators import tiles
from lociforge.operators.intervals import bins, overlap_join, union_intervals

SITE_BIN = 10_000
TARGET_BIN = 100_000
MARGIN = 5000


def base_at(bases: Column, offset: Column) -> Column:
    """The letter at an offset of ``bases``, which repeat if they are shorter; null without bases."""
    return F.substring(bases, offset % F.nullif(F.length(bases), F.lit(0)) + 1, F.lit(1))


def records_at(alignments: DataFrame, places: DataFrame, width: int = tiles.TILE) -> DataFrame:
    """Mapped records whose span meets or touches the union of ``places`` (ref_id, st, en): asked of a panel before CIGARs are taken apart.

    A semi-join on contig and tile, with the panel broadcast while Spark finds it small enough; records are not copied.  A tile knows the intervals of the union in it and the next one after
    them, so a record asks only the tile it begins in, for a few intervals.
    """
    panel = places.select("ref_id", F.least("st", "en").alias("st"), F.greatest("st", "en").alias("en"))
    order = Window.partitionBy("ref_id").orderBy("st")
    union = union_intervals(panel).withColumn("_from", F.coalesce(F.lag("en").over(order), F.lit(0)))
    known = union.select(F.col("ref_id").alias("_r"), F.col("st").alias("_st"), F.col("en").alias("_en"), F.explode(bins(F.least("_from", F.greatest("st", F.lit(0))), F.greatest(F.col("en") - 1, F.lit(0)), width)).alias("_t"))
    spanned = alignments.where("ref_id >= 0").withColumn("_te", F.col("pos0") + 1 + cigar.span(F.col("cigar")))
    at = F.floor(F.greatest("pos0", F.lit(0)) / width).cast("int")
    return spanned.join(known, (F.col("ref_id") == F.col("_r")) & (at == F.col("_t")) & (F.col("pos0") < F.col("_en")) & (F.col("_te") >= F.col("_st")), "left_semi").drop("_te")


def _ops_with_bases(alignments: DataFrame, ops: tuple[str, ...], *keep: str) -> DataFrame:
    """``op_intervals`` with ``bases`` and the offset ``q_start`` of the operation's first one in them.

    Of a read's ``seq`` an operation carries its own piece only, so the joins that follow move each base once; of a ``seq32``, a unit that the
    read's sequence repeats, the unit.
    """
    mapped = alignments.where("ref_id >= 0")
    if "seq" in alignments.columns:
        return cigar.op_intervals(mapped, ops, *keep, seq="seq").withColumn("q_start", F.lit(0))
    return cigar.op_intervals(mapped, ops, *keep, "seq32").withColumnRenamed("seq32", "bases")


def _records(alignments: DataFrame, ops: tuple[str, ...], *keep: str) -> DataFrame:
    """Mapped records as ``tiles.count_letters`` takes them: whole where a ``seq32`` is a unit that repeats, else an operation with its own piece of ``seq`` each."""
    if "seq" in alignments.columns:
        return _ops_with_bases(alignments, ops, "ref_id", *keep).select("ref_id", *keep, F.col("t_start").alias("start"), F.col("len").alias("span"), F.col("op").alias("ops"), F.array("len").alias("lens"), "bases")
    mapped = alignments.where("ref_id >= 0")
    letters = F.array_join(F.col("cigar.op"), "")
    return mapped.select("ref_id", *keep, cigar.start1(F.col("pos0")).alias("start"), cigar.span(F.col("cigar")).alias("span"), letters.alias("ops"), F.col("cigar.len").alias("lens"), F.col("seq32").alias("bases"))


def site_allele_counts(alignments: DataFrame, sites: DataFrame, min_depth: int = 20, width: int = tiles.TILE) -> DataFrame:
    """Reads' bases at known sites, as counts of the two alleles; sites with fewer than ``min_depth`` of both are left out.

    Letters are counted once per place, whatever the number of sites and reads there.  All mapped records count.
    """
    known = sites.groupBy("ref_id", "pos", "al0", "al1").agg(F.count("*").alias("times"))
    places = known.where("pos is not null").select("ref_id", F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"), "al0", "al1", "times")
    counted = tiles.count_letters(_records(alignments, cigar.PAIRED), places, by=("al0", "al1"), gaps=False, width=width)
    out = counted.select("ref_id", F.col("t").alias("pos"), "al0", "al1", (F.col("n0") * F.col("times")).alias("ref"), (F.col("n1") * F.col("times")).alias("alt"))
    return out.where(F.col("ref") + F.col("alt") >= min_depth)


def sites_in(sites: DataFrame, regions: DataFrame, width: int = TARGET_BIN) -> DataFrame:
    """Sites inside any region, both ends counted."""
    dealt = regions.select(F.col("ref_id").alias("_r"), "st", "en", F.explode(bins(F.col("st"), F.col("en"), width)).alias("_b"))
    at = F.floor(F.col("pos") / width).cast("int")
    return sites.join(dealt, (F.col("ref_id") == F.col("_r")) & (at == F.col("_b")) & F.col("pos").between(F.col("st"), F.col("en")), "left_semi")


def target_bases(alignments: DataFrame, targets: DataFrame, width: int = TARGET_BIN) -> DataFrame:
    """(read_name, aln_no, nm, bases): paired bases of each primary record in each target, margins left out."""
    primary = records_at(alignments.where(cigar.is_primary(F.col("flag"))), targets)
    ops = cigar.op_intervals(primary, cigar.PAIRED, "read_name", "aln_no", "ref_id")
    hits = overlap_join(ops, targets.select("ref_id", "st", "en", "nm"), "ref_id", "t_start", "t_end", "st", "en", width)
    return hits.select("read_name", "aln_no", "nm", (F.least("t_end", "en") - F.greatest("t_start", "st")).alias("bases"))


def qc_on_target(alignments: DataFrame, targets: DataFrame) -> DataFrame:
    """nt_on_target, reads_on_target (records counted once) and target_regions_nt."""
    per_record = target_bases(alignments, targets).groupBy("read_name", "aln_no").agg(F.sum("bases").alias("bases"))
    hit = per_record.agg(F.coalesce(F.sum("bases"), F.lit(0)).alias("nt_on_target"), F.count("*").alias("reads_on_target"))
    size = targets.agg(F.sum(F.col("en") - F.col("st")).cast("long").alias("target_regions_nt"))
    return hit.join(F.broadcast(size))  # two single rows


def focal_depth(alignments: DataFrame, targets: DataFrame) -> DataFrame:
    """Per gene name: bases in all its regions by their length; 0 where none was hit."""
    hit = target_bases(alignments, targets).groupBy("nm").agg(F.sum("bases").alias("bases"))
    size = targets.groupBy("nm").agg(F.sum(F.col("en") - F.col("st")).alias("size"))
    return size.join(hit, "nm", "left").select("nm", (F.coalesce("bases", F.lit(0)) / F.col("size")).alias("depth"))


def span_depth(alignments: DataFrame, targets: DataFrame, width: int = TARGET_BIN) -> DataFrame:
    """Per gene name: bases that mapped records span in its region by the region's length, deletions included; of regions with one name the last in the file counts."""
    reads = alignments.where("ref_id >= 0").select("ref_id", cigar.start1(F.col("pos0")).alias("ts"), (F.col("pos0") + 1 + cigar.span(F.col("cigar"))).alias("te"))
    last = targets.groupBy("nm").agg(F.max(F.struct("ord", "ref_id", "st", "en")).alias("x")).select("nm", "x.ref_id", "x.st", "x.en")
    met = overlap_join(reads, last, "ref_id", "ts", "te", "st", "en", width)
    sums = met.groupBy("nm").agg(F.sum(F.least("te", "en") - F.greatest("ts", "st")).alias("bases"))
    size = F.col("en") - F.col("st")
    return last.join(sums, "nm", "left").select("nm", F.when(size > 0, F.coalesce("bases", F.lit(0)) / F.nullif(size, F.lit(0))).otherwise(F.lit(0.0)).alias("depth"))


def gene_depth(alignments: DataFrame, targets: DataFrame, margin: int = MARGIN, min_anchor: int = 500) -> DataFrame:
    """Per target: bases that records span, deletions included, by its length.

    A record's targets are walked in file order, up to and with the first that it hits (see ``hit_reads``): later ones get nothing
    from that record.
    """
    sums = tiles.bases_up_to_first(_spans(alignments).drop("read_name", "aln_no"), widened(targets, margin), min_anchor).groupBy("nm").agg(F.sum("bases").alias("bases"))
    return targets.select("nm", (F.col("en") - F.col("st")).alias("size")).join(sums, "nm", "left").select("nm", (F.coalesce("bases", F.lit(0)) / F.col("size")).alias("depth"))


def _spans(alignments: DataFrame) -> DataFrame:
    return alignments.where("ref_id >= 0").select("read_name", "aln_no", "ref_id", cigar.start1(F.col("pos0")).alias("ts"), (F.col("pos0") + 1 + cigar.span(F.col("cigar"))).alias("te"))


def widened(targets: DataFrame, margin: int | Column) -> DataFrame:
    """Targets with their span widened by the margin, and the 10 kb bin of their middle."""
    middle = F.floor((F.col("st") + F.floor((F.col("en") - F.col("st")) / 2)) / SITE_BIN).cast("int")
    return targets.select("ref_id", "st", "en", "nm", "ord", middle.alias("bin"), F.greatest(F.col("st") - margin, F.lit(0)).cast("int").alias("g_st"), (F.col("en") + margin).cast("int").alias("g_en"))


def hit_reads(alignments: DataFrame, targets: DataFrame, margin: int | Column = MARGIN, min_anchor: int = 500) -> DataFrame:
    """Names of reads with a record that overlaps a widened target by more than ``min_anchor``."""
    return tiles.first_targets(_spans(alignments).drop("aln_no"), widened(targets, margin), min_anchor).where("_bin is not null").select("read_name").distinct()


def cds_pileup(alignments: DataFrame, cds: DataFrame, width: int = TARGET_BIN) -> DataFrame:
    """(gene, cds_pos, read_name, base): each record's base or gap (``-``) at each place of a gene's coding sequence, on its strand.

    Exons are 1-based and closed, offsets their running lengths; places are 0-based.  Operations are cut to the exons before they
    are exploded, so rows are bounded by the coding bases that reads cover.  A record without a sequence has base N.
    """
    exons = _exons(cds)
    genes = cds.groupBy("ref_id", "gene").agg(F.min("st").alias("st"), F.max("en").alias("en"))
    ops = _ops_with_bases(records_at(alignments, genes), (*cigar.PAIRED, "D"), "ref_id", "read_name", "aln_no")
    hits = overlap_join(ops, exons, "ref_id", "t_start", "t_end", "st", "past", width)
    place = F.explode(F.sequence(F.greatest("t_start", "st"), F.least("t_end", "past") - 1))
    rows = hits.withColumn("t", place)
    base = F.when(F.col("op") == "D", "-").otherwise(F.coalesce(base_at(F.col("bases"), F.col("q_start") + F.col("t") - F.col("t_start")), F.lit("N")))
    flipped = F.when(F.col("strand") == "-", F.translate(base, "ACGT", "TGCA")).otherwise(base)
    return rows.select("gene", _place().alias("cds_pos"), "read_name", "aln_no", flipped.alias("base"))


def _exons(cds: DataFrame) -> DataFrame:
    """Exons with their offset in the gene's coding sequence and its length."""
    order = Window.partitionBy("gene").orderBy("st")
    size = F.col("en") - F.col("st") + 1
    exons = cds.withColumn("offset", F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("cds_len", F.sum(size).over(Window.partitionBy("gene")))
    return exons.select("ref_id", "gene", "st", (F.col("en") + 1).alias("past"), "strand", "offset", "cds_len")


def _place() -> Column:
    """The place ``t`` of an exon in the coding sequence, on the gene's strand."""
    forward = F.col("offset") + F.col("t") - F.col("st")
    return F.when(F.col("strand") == "-", F.col("cds_len") - forward - 1).otherwise(forward).cast("int")


def pileup_counts(pileup: DataFrame) -> DataFrame:
    """Depth and counts of A, C, G, T, N and gaps per place."""
    counts = [F.count_if(F.col("base") == b).alias(name) for b, name in zip("ACGTN-", ("a", "c", "g", "t", "n", "del"), strict=True)]
    return pileup.groupBy("gene", "cds_pos").agg(F.count("*").alias("depth"), *counts)


def cds_counts(alignments: DataFrame, cds: DataFrame, width: int = tiles.TILE) -> DataFrame:
    """``pileup_counts`` of ``cds_pileup``, counted by place of the genome instead of from a row per base and gene."""
    places = _exons(cds).withColumns({"lo": F.col("st"), "hi": F.col("past")}).drop("past")
    counted = tiles.count_letters(_records(alignments, (*cigar.PAIRED, "D")), places, ("A", "C", "G", "T", "N" + chr(tiles.MISSING), "-"), width=width)
    minus = F.col("strand") == "-"
    strand = {"a": ("n0", "n3"), "c": ("n1", "n2"), "g": ("n2", "n1"), "t": ("n3", "n0"), "n": ("n4", "n4"), "del": ("n5", "n5")}
    rows = counted.select("gene", _place().alias("cds_pos"), "depth", *[F.when(minus, F.col(down)).otherwise(F.col(up)).alias(name) for name, (up, down) in strand.items()])
    return rows.groupBy("gene", "cds_pos").agg(*[F.sum(c).alias(c) for c in ("depth", *strand)])


def mean_depth(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per gene of ``sizes`` (gene, size): the mean depth over its whole coding sequence, places without reads included."""
    sums = counts.groupBy("gene").agg(F.sum("depth").alias("bases"))
    return sizes.join(sums, "gene", "left").select("gene", (F.coalesce("bases", F.lit(0)) / F.nullif(F.col("size"), F.lit(0))).alias("depth"))


def call_variants(counts: DataFrame, reference: DataFrame | None, min_coverage: int = 10, min_frequency: float = 0.3) -> DataFrame:
    """The most frequent base other than the reference's, in the order A, C, G, T, gap on ties, where depth and frequency suffice.

    ``reference``: gene, cds_pos, ref; null where ``counts`` has the column already.  The frequency is single precision widened to double before it is compared: 3 of 10 exceeds 0.3.
    """
    alleles = [("a", "A"), ("c", "C"), ("g", "G"), ("t", "T"), ("del", "-")]
    options = F.array(*[F.struct(F.when(F.col("ref") == b, F.lit(-1).cast("long")).otherwise(F.col(c)).alias("n"), F.lit(-i).alias("p"), F.lit(b).alias("b")) for i, (c, b) in enumerate(alleles)])
    known = counts if reference is None else counts.join(reference, ["gene", "cds_pos"])
    best = known.withColumn("best", F.array_max(options))
    af = (F.col("best.n").cast("float") / F.col("depth").cast("float")).cast("float").cast("double")
    called = best.where(F.col("depth") >= min_coverage).withColumn("af", af).where(F.col("af") > min_frequency)
    return called.select("gene", (F.col("cds_pos") + 1).alias("pos"), "ref", F.col("best.b").alias("alt"), "af", "depth")


def phase(calls: DataFrame, alignments: DataFrame, cds: DataFrame, ratio: float = 4.0) -> DataFrame:
    """Pairs of a gene's variants with reads in cis and trans and the phase: alt/alt, ref/alt or null.

    A read's base at a place is its last record's there.  Reads with both reference bases count as cis.  A record is one row per gene, with its bases at the calls.
    """
    exons = _exons(cds)
    forward = F.when(F.col("strand") == "-", F.col("cds_len") - F.col("pos")).otherwise(F.col("pos") - 1)
    placed = calls.select("gene", "pos").join(exons, "gene").withColumn("t", (F.col("st") + forward - F.col("offset")).cast("int")).where((F.col("t") >= F.col("st")) & (F.col("t") < F.col("past")))
    places = placed.select("ref_id", "t", "gene", "pos", (F.col("strand") == "-").alias("minus"))
    shown = tiles.letters_of_reads(_records(alignments, (*cigar.PAIRED, "D"), "read_name", "aln_no"), places, exons.select("ref_id", F.col("st").alias("lo"), F.col("past").alias("hi")))
    counted = tiles.pairs_of_calls(shown, calls)
    status = F.when((F.col("cis") > 1) & (F.col("cis") > F.col("trans") * ratio), "alt/alt").when((F.col("trans") > 1) & (F.col("trans") > F.col("cis") * ratio), "ref/alt")
    return counted.withColumn("phase", status)


def _indels(alignments: DataFrame, regions: DataFrame, min_length: int | None = None) -> DataFrame:
    """``tiles.indels`` of the records at any region."""
    mapped = records_at(alignments, regions)
    letters = F.array_join(F.col("cigar.op"), "")
    return tiles.indels(mapped.select("ref_id", cigar.start1(F.col("pos0")).alias("start"), cigar.span(F.col("cigar")).alias("span"), letters.alias("ops"), F.col("cigar.len").alias("lens")), min_length)


def _named(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions whose name is theirs alone, and those that share one."""
    counted = regions.withColumn("_same", F.count("*").over(Window.partitionBy("nm")))
    return counted.where("_same = 1").drop("_same"), counted.where("_same > 1").drop("_same")


def _indels_in(indels: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """``indels`` with each region (nm, st, e) that they are in: insertions start in it, deletions touch it."""
    reach = F.when(F.col("length") < 0, F.greatest(F.col("pos") - F.col("length"), F.col("pos") + 1)).otherwise(F.col("pos") + 1)
    hits = overlap_join(indels.withColumn("reach", reach), regions.select("ref_id", "st", F.col("en").alias("e"), (F.col("en") + 1).alias("past"), "nm"), "ref_id", "pos", "reach", "st", "past", width)
    inside = F.when(F.col("pos") >= F.col("st"), F.col("solid") + F.col("padding")).otherwise(F.col("solid"))
    return hits.where((F.col("length") <= 0) | (F.col("pos") < F.col("e"))).withColumn("n", inside).where("n > 0")


def insertions(alignments: DataFrame, regions: DataFrame, width: int = tiles.TILE) -> DataFrame:
    """(nm, pos, length, n): insertions (positive) that start in a region and deletions (negative) that touch it, per place and length.

    They are counted per place before regions come in, so a region that has its name alone copies what is counted; only regions that share a name are counted together.
    """
    indels = _indels(alignments, regions)
    alone, shared = _named(regions)
    together = _indels_in(indels, shared, width).groupBy("nm", "pos", "length").agg(F.sum("n").alias("n"))
    return _indels_in(indels, alone, width).select("nm", "pos", "length", "n").unionByName(together)


def region_coverage(alignments: DataFrame, points: DataFrame, width: int = tiles.TILE) -> DataFrame:
    """Coverage (paired bases, deletions and skips) at (ref_id, pos) points: the records whose span holds them."""
    spans = alignments.where("ref_id >= 0").select("ref_id", cigar.start1(F.col("pos0")).alias("start"), cigar.span(F.col("cigar")).alias("span"))
    whole = spans.select("*", F.lit("M").alias("ops"), F.array("span").alias("lens"), F.lit(None).cast("string").alias("bases"))
    places = points.select("ref_id", F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"))
    return tiles.count_letters(whole, places, width=width).select("ref_id", F.col("t").alias("pos"), F.col("depth").alias("coverage"))


def internal_duplications(alignments: DataFrame, regions: DataFrame, min_length: int = 4, min_frequency: float = 0.0) -> DataFrame:
    """Insertions of at least ``min_length`` seen twice or more, each with the similar events around it added to ``merged``.

    Similar: within 1.1 lengths' distance and a length within 10 %; singletons are absorbed as well.  With a frequency set, merged must be that share of the other reads, and events that
    outnumber them go.  Events, what is near them and their coverage are found once per place; a region takes of what is near what lies in it.  Regions that share a name are joined by name.
    """
    alone, shared = _named(regions)
    if min_length < 1:  # deletions are events too
        out = _duplications_by_name(alignments, regions, min_length)
    else:
        out = _duplications_by_place(alignments, alone, min_length).unionByName(_duplications_by_name(alignments, shared, min_length))
    if min_frequency > 0:
        rest = F.col("coverage") - F.col("merged")
        out = out.where((rest > 0) & (F.col("merged") / rest >= min_frequency))
    return out


def _near(length: str, pos: str) -> Column:
    """Whether the event (``_len``, ``_pos``) counts as one with that of the columns named, and is another."""
    near = (F.abs(F.col(pos) - F.col("_pos")) < (F.col(length) * 1.1).cast("int")) & (F.col("_len") * 0.9 < F.col(length)) & (F.col(length) < F.col("_len") * 1.1)
    return near & ((F.col(pos) != F.col("_pos")) | (F.col(length) != F.col("_len")))


def _duplications_by_place(alignments: DataFrame, alone: DataFrame, min_length: int, width: int = tiles.TILE) -> DataFrame:
    known = _indels(alignments, alone, min_length).where("near is not null").select("ref_id", "pos", "length", F.col("solid").alias("n"), "near", "coverage")
    hits = overlap_join(known.withColumn("past", F.col("pos") + 1), alone.select("ref_id", "st", F.col("en").alias("e"), "nm"), "ref_id", "pos", "past", "st", "e", width)
    total = lambda rows: F.aggregate(rows, F.lit(0).cast("long"), lambda n, x: n + x["n"])
    inside = total(F.filter("near", lambda x: (x["pos"] >= F.col("st")) & (x["pos"] < F.col("e"))))
    return hits.select("nm", "pos", "length", (F.col("n") + inside).alias("merged"), "coverage")


def _duplications_by_name(alignments: DataFrame, regions: DataFrame, min_length: int) -> DataFrame:
    counts = insertions(alignments, regions)
    events = counts.where((F.col("length") >= min_length) & (F.col("n") > 1)).join(regions.select("ref_id", "nm", F.col("en").alias("e")), "nm")
    other = counts.select(F.col("nm").alias("_nm"), F.col("pos").alias("_pos"), F.col("length").alias("_len"), F.col("n").alias("_n"))
    absorbed = events.join(other, (F.col("nm") == F.col("_nm")) & _near("length", "pos"), "left").groupBy("ref_id", "nm", "pos", "length", "n", "e").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("more"))
    places = events.where("pos < e").select("ref_id", "nm", "pos", "e").distinct()
    covered = places.join(region_coverage(alignments, places.select("ref_id", "pos").distinct()), ["ref_id", "pos"]).groupBy("nm", "pos").agg(F.sum("coverage").alias("coverage"))
    return absorbed.join(covered, ["nm", "pos"], "left").select("nm", "pos", "length", (F.col("n") + F.col("more")).alias("merged"), F.coalesce("coverage", F.lit(0)).alias("coverage"))
