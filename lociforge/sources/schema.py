"""Spark types as JSON Schema, and the schema of a result document."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

_PAIR = "struct<gene0_name:string,gene0_chr:string,gene0_pos:bigint,gene0_dir:string,gene1_name:string,gene1_chr:string,gene1_pos:bigint,gene1_dir:string,n_reads:bigint,overlap_gap:bigint>"
_GENE = "struct<name:string,chr:string,pos:bigint>"
_FUSION = f"array<struct<gene1:{_GENE},gene2:{_GENE},supporting_reads:bigint,repetitive_reads:bigint,breakpoints:array<{_PAIR}>>>"
_SPAN = "array<struct<chrom:string,start:bigint,end:bigint,reads:bigint>>"

#: The sections of one sample's result, as a DDL schema that readers of many results can use; fixed values of the document's format.
RESULT = f"""version string not null, timestamp string not null,
metadata struct<run_start_time:string,run_id:string,basecall_model:string,library_id:string,sequencer_id:string,flow_cell_id:string>,
qc struct<nt_on_target:double,reads_on_target:double,target_regions_nt:double,reads_aligned:bigint,mean_coverage:double,target_coverage:map<string,double>>,
fusions struct<fusions:{_FUSION},spike_in:{_FUSION}>,
karyotype struct<karyotype:map<string,int>,medians:map<string,double>,levels_found:array<array<double>>,karyotype_string:string,iscn_string:string,blast_ratio:double,reads_aligned:bigint,within_segment_spread:double,warnings:string,maf_peaks:map<string,double>>,
cnv struct<genes:map<string,struct<focal:double,local:double,deletions:{_SPAN},duplications:{_SPAN}>>>,
snv struct<genes:map<string,struct<genotype:string,coverage:double,mutations:map<string,string>,aa_changes:array<string>,phase:map<string,string>,unassigned_muts:array<string>>>>,
itd struct<genes:map<string,array<struct<position:bigint,length:bigint,merged:bigint,coverage:bigint>>>>,
breakpoint_consensus struct<breakpoints:array<struct<gene0_name:string,gene0_chr:string,gene0_pos:bigint,gene1_name:string,gene1_chr:string,gene1_pos:bigint,consensus_sequence:string,bracketed_sequence:string,inserted_bases:string,n_reads:bigint,mean_coverage:double>>>"""

_PLAIN = {T.StringType: "string", T.BooleanType: "boolean", T.LongType: "integer", T.IntegerType: "integer", T.DoubleType: "number", T.FloatType: "number"}


def json_schema(kind: T.DataType, title: str | None = None) -> dict:
    """A type as JSON Schema: structs are closed objects, maps open ones; fields that may be null need not be there."""
    head = {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title} if title else {}
    if isinstance(kind, T.StructType):
        fields = {f.name: json_schema(f.dataType) if not f.nullable else _or_null(json_schema(f.dataType)) for f in kind.fields}
        return head | {"type": "object", "properties": fields, "required": [f.name for f in kind.fields if not f.nullable], "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return head | {"type": "array", "items": json_schema(kind.elementType)}
    if isinstance(kind, T.MapType):
        return head | {"type": "object", "additionalProperties": json_schema(kind.valueType)}
    return head | {"type": _PLAIN[type(kind)]}


def _or_null(schema: dict) -> dict:
    return schema | {"type": [schema["type"], "null"]}


def result_schema() -> dict:
    """The JSON Schema of a result document; Spark parses the DDL, so a session is started if there is none."""
    SparkSession.builder.getOrCreate()
    return json_schema(T.StructType.fromDDL(RESULT), title="result")


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a JSON value breaks a schema made by ``json_schema``."""
    kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
    if value is None:
        return [] if "null" in kinds else [f"{at}: null"]
    fits = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float)}[kinds[0]]
    if not isinstance(value, fits) or isinstance(value, bool) and kinds[0] != "boolean":
        return [f"{at}: not {kinds[0]}"]
    if kinds[0] == "array":
        return [w for i, v in enumerate(value) for w in violations(v, schema["items"], f"{at}[{i}]")]
    if kinds[0] != "object":
        return []
    known, rest = schema.get("properties", {}), schema["additionalProperties"]
    wrong = [f"{at}: missing {k}" for k in schema.get("required", []) if k not in value]
    for k, v in value.items():
        if k in known:
            wrong += violations(v, known[k], f"{at}.{k}")
        else:
            wrong += [f"{at}: unknown {k}"] if rest is False else violations(v, rest, f"{at}.{k}")
    return wrong
