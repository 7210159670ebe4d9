"""Indexed FASTA as fixed chunks of sequence, and regions cut from them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 65_536


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length, offset, bases, width): the index's lines; ``bases`` and ``width`` are a line's letters and bytes."""
    f = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("f"))
    return f.select(F.col("f")[0].alias("contig"), *[F.col("f")[i].cast("long").alias(n) for i, n in enumerate(("length", "offset", "bases", "width"), 1)])


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK, index: str | None = None) -> DataFrame:
    """(contig, chunk_no, seq) in capitals: each task opens the file and reads the byte ranges of its chunks only, never a whole contig.

    ``path`` is one that the executors can open (a local one or a URI known to Arrow); a missing index is an error.
    """
    chunks = read_fai(spark, index or f"{path}.fai").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("length") - 1) / chunk), F.lit(0)))).alias("chunk_no")
    )
    at = lambda base: F.col("offset") + F.floor(base / F.col("bases")) * F.col("width") + base % F.col("bases")
    first, last = F.col("chunk_no") * chunk, F.least((F.col("chunk_no") + 1) * chunk, F.col("length"))
    ranges = chunks.where("length > 0").select("contig", F.col("chunk_no").cast("int").alias("chunk_no"), at(first).alias("lo"), (at(last - 1) + 1).alias("hi"))
    return ranges.repartitionByRange("contig", "chunk_no").mapInPandas(lambda frames: _read_ranges(frames, path), "contig string, chunk_no int, seq string")


def _read_ranges(frames: Iterator[pd.DataFrame], path: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with system.open_input_file(name) as f:
        for frame in frames:
            cut = [f.read_at(int(hi - lo), int(lo)).translate(None, b"\r\n").decode().upper() for lo, hi in zip(frame.lo, frame.hi)]
            yield pd.DataFrame({"contig": frame.contig, "chunk_no": frame.chunk_no, "seq": cut})


def region_sequences(reference: DataFrame, regions: DataFrame, chunk: int = CHUNK, contig: str = "contig") -> DataFrame:
    """``regions`` (contig, st, en, further columns; half open) with ``seq``; what lies past the contig's end is missing from it.

    An equi-join on (contig, chunk): a region meets only the chunks it covers.  An empty region or unknown contig has an empty sequence.
    """
    numbered = regions.withColumn("_id", F.monotonically_increasing_id())
    need = numbered.where("en > st").select("_id", contig, "st", "en", F.explode(F.expr(f"sequence(cast(st div {chunk} as int), cast((en - 1) div {chunk} as int))")).alias("chunk_no"))
    lo = F.greatest(F.col("st") - F.col("chunk_no") * chunk, F.lit(0))
    piece = F.col("seq").substr((lo + 1).cast("int"), (F.least(F.col("en") - F.col("chunk_no") * chunk, F.lit(chunk)) - lo).cast("int"))
    parts = need.join(reference.select(contig, "chunk_no", "seq"), [contig, "chunk_no"]).select("_id", F.struct("chunk_no", piece.alias("s")).alias("p"))
    whole = parts.groupBy("_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["s"]), "").alias("seq"))
    return numbered.join(whole, "_id", "left").withColumn("seq", F.coalesce("seq", F.lit(""))).drop("_id")
