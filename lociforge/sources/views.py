"""Genomic views of the driver's star-schema tables: synthetic reads, targets, sites and coverage bins.

The texts are SQL that Spark and DuckDB read alike; ``load`` runs one on Spark, the oracles inline them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTIG_LENGTH = 5_000_000
BIN = 100_000

VIEWS: dict[str, str] = {
    "aln": """
        select concat('r', cast(l_orderkey as string)) as read_name,
               row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as aln_no,
               cast(l_suppkey % 24 as int) as ref_id,
               cast((l_partkey * 7919 + l_linenumber * 104729) % 5000000 as int) as pos0,
               cast((case when l_linestatus = 'O' then 16 else 0 end) + (case when l_linenumber > 1 then 2048 else 0 end)
                    + (case when l_discount > 0.095 then 256 else 0 end) as int) as flag,
               cast(l_linenumber * 200 as int) as c_s1, cast(600 + l_quantity * 20 as int) as c_m1, cast(l_quantity as int) as c_d,
               cast(400 as int) as c_m2, cast(l_linenumber * 3 as int) as c_i, cast(300 as int) as c_m3,
               translate(md5(concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq32
        from lineitem""",
    "targets": """
        select cast(s_suppkey % 24 as int) as ref_id, cast((s_suppkey * 49999) % 4900000 as int) as st,
               cast((s_suppkey * 49999) % 4900000 + 20000 + s_nationkey * 1000 as int) as en, concat('G', cast(s_suppkey as string)) as nm,
               cast(s_suppkey as int) as ord
        from supplier""",
    "sites": """
        select distinct cast(o_custkey % 24 as int) as ref_id, cast((o_orderkey * 331) % 5000000 as int) as pos,
               substr('ACGT', cast(1 + o_orderkey % 4 as int), 1) as al0, substr('ACGT', cast(1 + (o_orderkey + 1) % 4 as int), 1) as al1
        from orders""",
    "repeats": """
        select cast(p_partkey % 24 as int) as ref_id, cast((p_partkey * 2503) % 5000000 as int) as st,
               cast((p_partkey * 2503) % 5000000 + p_size * 100 as int) as en
        from part""",
    "cov_bins": """
        select case when user_id % 24 = 22 then 'chrX' when user_id % 24 = 23 then 'chrY' else concat('chr', cast(1 + user_id % 24 as string)) end as chrom,
               cast((event_id % 50) * 100000 as int) as st, cast((event_id % 50 + 1) * 100000 as int) as en,
               round(sum(value) + 50 + 40 * (case when user_id % 24 in (4, 9) then 1 else 0 end), 3) as coverage,
               min(0.3 + 0.4 * (event_id % 100) / 100) as gc
        from events group by user_id % 24, event_id % 50""",
    "refseq": """
        select cast(doc_id % 24 as int) as ref_id, cast(doc_id as int) as chunk_no,
               translate(text, 'acgtbdefhijklmnopqrsuvwxyz ', 'ACGTACGTACGTACGTACGTACGTACG') as seq
        from documents where text is not null""",
    "cds": """
        select concat('G', cast(s_suppkey as string)) as gene, cast(s_suppkey % 24 as int) as ref_id, e as exon,
               cast((s_suppkey * 49999) % 4900000 + e * 300 as int) as st, cast((s_suppkey * 49999) % 4900000 + e * 300 + 89 as int) as en,
               case when s_suppkey % 2 = 0 then '+' else '-' end as strand
        from supplier cross join (select 0 as e union all select 1 union all select 2) x""",
}
#: The tables that a view reads.
TABLES = {"aln": "lineitem", "targets": "supplier", "sites": "orders", "repeats": "part", "cov_bins": "events", "refseq": "documents", "cds": "supplier"}


def spread(scan: DataFrame, key: str) -> DataFrame:
    """``scan`` dealt out to all cores by ``key`` where its files have fewer splits than that; larger inputs stay as they are read."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A view over the Parquet tables of ``sf_dir``; no temporary view is registered."""
    table = TABLES[view]
    scan = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(re.sub(rf"\bfrom {table}\b", f"from {{{table}}}", VIEWS[view]), **{table: spread(scan, "l_orderkey") if view == "aln" else scan})


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``aln`` in the engine's schema: read_name, aln_no, ref_id, pos0, flag, cigar, seq32 (base at query offset q is seq32[q % 32])."""
    op = lambda name, col: F.struct(F.lit(name).alias("op"), F.col(col).alias("len"))
    cigar = F.array(op("S", "c_s1"), op("M", "c_m1"), op("D", "c_d"), op("M", "c_m2"), op("I", "c_i"), op("M", "c_m3"))
    return load(spark, sf_dir, "aln").select("read_name", F.col("aln_no").cast("int").alias("aln_no"), "ref_id", "pos0", "flag", cigar.alias("cigar"), "seq32")


def with_views(sql: str) -> str:
    """An oracle's text with the views that it names as common table expressions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    head = ", ".join(f"{v} as ({VIEWS[v]})" for v in used)
    return f"with {head}, {sql.strip()[5:]}" if sql.strip().lower().startswith("with ") else f"with {head} {sql}"
