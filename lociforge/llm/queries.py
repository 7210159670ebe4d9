"""The thin queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociforge.llm import bpe, chat_format, decontaminate, embedding_dedup, html_extract, ngram_join, secret_scan, substring_dedup, toxicity, url_filter

RULES = (
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
)

#: The conversation of control strings that op5 adds.
TRICKY = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract_pages(_table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(2, numPartitions=1).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return chat_format.chat_digest(chat_format.format_chats(turns.unionByName(extra)))


def secret_forest(vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> secret_scan.Forest:
    """The forest of the made findings; its dictionary takes in the words of a public tokenizer's vocabulary."""
    import public_tokenizers

    return secret_scan.fit_forest(secret_scan.labelled_findings(), words=secret_scan.vocabulary_words(public_tokenizers.path(vocabulary)))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), secret_forest())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination_digest(found)


def tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.encode_digest(tokenizer(), F.col("text")).alias("x")).select("doc_id", "x.*")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


_HOST = r"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _fits(rule: url_filter.Rule) -> str:
    return f"(host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}')"


def _case(value: Callable[[url_filter.Rule], str]) -> str:
    longest_first = sorted(RULES, key=lambda r: -len(r.key))
    return "case " + " ".join(f"when {_fits(r)} then '{value(r)}'" for r in longest_first)


def oracle_sql() -> dict[str, str]:
    escaped = r"replace(replace(replace(replace({}, '\', '\\'), '###', '\#'), '</turn>', '\/'), ': ', '\;')"
    words = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    white = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return {
        "op1_ngram_join": f"""
            with recursive d as (select doc_id, {white} as w from documents),
            s as (select distinct doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') as g
                  from (select doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from d where len(w) > 0)),
            n as (select doc_id, count(*) as n from s group by 1),
            o as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
            e as (select x, y from o join n p on p.doc_id = x join n q on q.doc_id = y where 100 * shared >= 75 * (p.n + q.n - shared)),
            u as (select x, y from e union all select y, x from e),
            r as (select doc_id, doc_id as seen from d union select r.doc_id, u.y from r join u on r.seen = u.x)
            select d.doc_id, coalesce(max(n.n), 0)::bigint as n_shingles, min(seen) as component_id from d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by 1""",
        "op3_embedding_dedup": """
            with recursive v as (select vec_id, label, embedding::double[] as x from embeddings
                       where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(embedding, lambda c: c <> 0)) > 0),
            e as (select a.vec_id as p, b.vec_id as q from v a join v b on a.label = b.label and a.vec_id < b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.93),
            u as (select p, q from e union all select q, p from e),
            r as (select vec_id, vec_id as seen from embeddings union select r.vec_id, u.q from r join u on r.seen = u.p),
            c as (select vec_id, min(seen) as component_id from r group by 1), k as (select p as vec_id, count(*) as n from u group by 1)
            select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from c left join k using (vec_id)""",
        "op9_url_filter": f"""
            select page_id, host, path, {_case(lambda r: r.key)} end as rule, {_case(lambda r: r.action)} else 'allow' end as verdict
            from (select page_id, {_HOST} as host, {_PATH} as path from pages)""",
        "op5_chat_format": f"""
            with t as (
              select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
              union all select -7, 0, 'user', '{TRICKY}' union all select -7, 1, 'assistant', '{TRICKY}'),
            w as (
              select *, '### ' || case role when 'system' then 'System' when 'user' then 'User' when 'assistant' then 'Assistant'
                                  else '@' || {escaped.format("role")} end || ': ' || {escaped.format("text")} || '</turn>' || chr(10) as shown from t),
            m as (
              select *, case when role = 'system' then before is null
                             when role = 'user' then before is null or before in ('system', 'assistant')
                             when role = 'assistant' then before is not distinct from 'user' else false end as fits,
                     next is null and role = 'assistant' as ends
              from (select *, lag(role) over o as before, lead(role) over o as next from w
                    window o as (partition by conv_id order by turn nulls first, role, text)))
            select conv_id, count(*) as n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
                   coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
                   sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
                   sum(length(shown))::bigint as formatted_chars, bool_and(fits) and bool_or(ends) as valid
            from m group by conv_id""",
        "op7_decontaminate": f"""
            with b as (select item_id, w, least(len(w), 10) as n from (select item_id, {words} as w from benchmark) where len(w) > 0),
            g as (select distinct item_id, n, list_slice(w, i, i + n - 1) as gram from (select *, unnest(range(1, len(w) - n + 2)) as i from b)),
            d as (select doc_id, {words} as w from documents),
            s as (select distinct n from g),
            x as (select doc_id, n, i, list_slice(w, i, i + n - 1) as gram
                  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, s where len(w) >= n)),
            h as (select doc_id, item_id, i, x.n from x join g on x.n = g.n and x.gram = g.gram),
            p as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from h) group by 1),
            q as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
                  from (select distinct doc_id, item_id::varchar as item from h) group by 1)
            select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
                   sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
            from d left join p on p.doc_id = d.doc_id left join q on q.doc_id = d.doc_id""",
    }
