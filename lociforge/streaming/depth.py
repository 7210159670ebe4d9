"""Read depth over a stream of arriving alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lociforge.operators.coverage import bin_counts


def stream_bin_counts(alignments: DataFrame, name: str, width: int, checkpoint: str) -> StreamingQuery:
    """Running read counts per bin as an in-memory table ``name``; state is one row per bin, so it is bounded by the genome."""
    out = bin_counts(alignments, width)
    return out.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()
