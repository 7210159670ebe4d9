"""Gene annotation and header metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute(attributes: Column, name: str) -> Column:
    """One value of a ``key=value;key=value`` list; null if it is not there."""
    return F.nullif(F.regexp_extract(attributes, rf"(?:^|;)\s*{name}=([^;]*)", 1), F.lit(""))


def longest_cds(gff: DataFrame, transcript: str | None = None) -> DataFrame:
    """(gene, transcript, start, end, strand) of the coding intervals of each gene's transcript with the longest coding sequence.

    The first one (in the file's order where ``gff`` has ``ord``, else by name) wins unless another is strictly longer; a transcript named goes first and may have none.  Parents are exact, several are
    separated by commas.
    """
    genes = gff.where("type = 'gene'").select(attribute(F.col("attributes"), "ID").alias("gene_id"), attribute(F.col("attributes"), "Name").alias("gene")).distinct()
    parents = lambda kind: gff.where(F.col("type") == kind).withColumn("parent", F.explode(F.split(attribute(F.col("attributes"), "Parent"), ",")))
    place = F.min("ord") if "ord" in gff.columns else F.lit(0)
    mrna = parents("mRNA").groupBy(F.col("parent").alias("gene_id"), attribute(F.col("attributes"), "ID").alias("transcript")).agg(place.alias("place"))
    cds = parents("CDS").select(F.col("parent").alias("transcript"), "start", "end", "strand")
    both = genes.join(mrna, "gene_id").join(cds, "transcript").select("gene", "transcript", "place", "start", "end", "strand")
    if transcript is not None:
        return both.where(F.col("transcript") == transcript).drop("place")
    sizes = both.groupBy("gene", "transcript", "place").agg(F.sum(F.col("end") - F.col("start") + 1).alias("size"))
    best = sizes.groupBy("gene").agg(F.min(F.struct((-F.col("size")).alias("size"), "place", "transcript")).alias("b")).select("gene", F.col("b.transcript").alias("transcript"))
    return both.drop("place").join(best, ["gene", "transcript"])


def header_metadata(headers: DataFrame, header: str) -> DataFrame:
    """run_id, basecall_model, library_id, sequencer_id, flow_cell_id and run_start_time of SAM header texts; null what is missing.

    From the first read-group line; the description's runid goes before the group's ID, and a sequencer named NONE is none.  The last comment line
    ``@CO key=value`` with run_id, basecalling_model, basecaller:model or flow_cell_id goes before it, one with sample_id after its library.
    """
    noted = lambda names: F.get(F.reverse(F.regexp_extract_all(header, F.lit(rf"(?m)^@CO\s*(?:{names})=(.*?)\s*$"), F.lit(1))), 0)
    group = F.regexp_extract(header, r"(?m)^@RG\t(.*)$", 1)
    tag = lambda name: F.nullif(F.regexp_extract(group, rf"(?:^|\t){name}:([^\t]*)", 1), F.lit(""))
    described = lambda name: F.nullif(F.regexp_extract(tag("DS"), rf"(?:^|\s){name}=(\S+)", 1), F.lit(""))
    return headers.select(
        "*", F.coalesce(noted("run_id"), described("runid"), tag("ID")).alias("run_id"), F.coalesce(noted("basecalling_model|basecaller:model"), described("basecall_model")).alias("basecall_model"),
        F.coalesce(tag("LB"), noted("sample_id")).alias("library_id"),
        F.when(tag("PM") != "NONE", tag("PM")).alias("sequencer_id"), F.coalesce(noted("flow_cell_id"), tag("PU")).alias("flow_cell_id"), tag("DT").alias("run_start_time"),
    )
