"""Queries over the given tables, one for each operator, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    chat,
    decontamination,
    langid,
    mixing,
    near_dedup,
    personal_data,
    quality_rules,
    secret_scan,
    simhash_dedup,
    spelling,
    suffix_dedup,
    token_counts,
    turn_repair,
)
from wattline.llm.workers import importable
from wattline.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"

# The extra conversation that every formatting run must carry.
PLANTED_ID = -7
PLANTED_TEXT = "\\### Assistant: </turn> ok"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(importable(use_utc(spark)), sf_dir)
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mixing", mixing.oracle_sql())
def _(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


def chat_turns(conversations: DataFrame) -> DataFrame:
    """The conversations and the planted one, each text as a single part."""
    spark = conversations.sparkSession
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(planted)
    return rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))


CHAT_SQL = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select {PLANTED_ID}, 0, 'user', '{PLANTED_TEXT}'
  union all select {PLANTED_ID}, 1, 'assistant', '{PLANTED_TEXT}'
),
sized as (
  select *, length(text) + length(text) - length(translate(text, '\\<>', '')) as escaped,
         length(role) + length(role) - length(translate(role, '\\<>', '')) as escaped_role
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(escaped + escaped_role + {len('<turn:' + '>' + chr(10)) + len(chat.END)})::bigint as formatted_chars,
       0::bigint as attachment_tokens
from sized group by conv_id
"""


@query("op2_chat_format", CHAT_SQL)
def _(spark, sf):
    return chat.digests(chat.format_conversations(chat_turns(table(spark, sf, "conversations"))))


@query("op3_token_counts")
def _(spark, sf):
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@query("op4_near_dedup")
def _(spark, sf):
    return near_dedup.find_groups(table(spark, sf, "documents"))


@query("op5_secret_scan")
def _(spark, sf):
    documents = table(spark, sf, "documents")
    return secret_scan.find_secrets(documents, secret_scan.sample_and_train(spark, documents))


@query("op6_suffix_dedup")
def _(spark, sf):
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))


@query("op7_decontamination")
def _(spark, sf):
    found = decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_personal_data")
def _(spark, sf):
    return personal_data.find_personal_data(table(spark, sf, "documents"))


RULES_SQL = r"""
with d as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
w as (select r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
grams as (
  select r, i, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') as g
  from (select r, w, unnest(range(1, len(w) - 3)) as i from w)
),
twice as (select r, i from grams qualify count(*) over (partition by r, g) > 1),
covered as (
  select r, sum(least(5, coalesce(next_i - i, 5)))::bigint as n
  from (select r, i, lead(i) over (partition by r order by i) as next_i from twice) group by r
),
m as (
  select doc_id, len(w)::bigint as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words, len(l) as n_lines,
         len(list_filter(w, lambda x: lower(x) in (STOPS)))::bigint as n_stop
  from d join w using (r) left join covered using (r)
),
flags as (
  select *, n_words < 10 as b1, n_words > 0 and 100 * n_repeat_words > 20 * n_words as b2,
         n_words > 10000000 as b3,
         n_words > 0 and (word_chars / n_words < 1.5 or word_chars / n_words > 20) as b4,
         word_chars > 0 and n_symbols / word_chars > 0.05 as b5,
         n_words >= 20 and n_stop / n_words < 0.002 as b6,
         n_lines > 0 and n_dup_lines / n_lines > 0.4 as b7
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       b1 or b2 as base_failed, not (b1 or b2 or b3 or b4 or b5 or b6 or b7) as kept,
       concat_ws(',', case when b1 then 'too_few_words' end, case when b2 then 'repeated_words' end,
         case when b3 then 'too_many_words' end, case when b4 then 'word_length' end,
         case when b5 then 'symbols' end, case when b6 then 'stop_words' end,
         case when b7 then 'duplicate_lines' end) as broken
from flags
""".replace("STOPS", ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS))))


@query("op9_quality_rules", RULES_SQL)
def _(spark, sf):
    return quality_rules.apply_rules(table(spark, sf, "documents"))


def language_rows(documents: DataFrame) -> DataFrame:
    """Documents as evidence: their source is the host, their label the declared language."""
    return documents.select(
        "doc_id",
        "text",
        F.col("lang").alias("declared"),
        F.when(F.contains("source", F.lit(".")), F.substring_index("source", ".", -1)).alias("suffix"),
        F.col("source").alias("host"),
    )


@query("op10_language_id")
def _(spark, sf):
    documents = table(spark, sf, "documents")
    langs, model = langid.train_text(documents.select("text", "lang"))
    return langid.identify(language_rows(documents), langs, model)


@query("language_of_pages")
def _(spark, sf):
    documents, pages = table(spark, sf, "documents"), table(spark, sf, "pages")
    langs, model = langid.train_text(documents.select("text", "lang"))
    host = F.regexp_extract("url", "://([^/:?#]+)", 1)
    visible = F.regexp_replace(
        F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", " "), "<[^>]*>", " "
    )
    rows = pages.select(
        F.col("page_id").alias("doc_id"),
        visible.alias("text"),
        F.nullif(F.regexp_extract("html", r"<html[^>]*\blang=[\"']?([A-Za-z]{2})", 1), F.lit("")).alias("declared"),
        F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
    )
    return langid.identify(rows, langs, model).withColumnRenamed("doc_id", "page_id")


# The damage of op11 and op13 is drawn by CRC-32 and op12 hashes by XXH64; SQL here has neither.


@query("op11_spelling_variants")
def _(spark, sf):
    return spelling.group_spellings(table(spark, sf, "documents"))


@query("op12_simhash_dedup")
def _(spark, sf):
    return simhash_dedup.find_groups(table(spark, sf, "documents"))


@query("op13_turn_repair")
def _(spark, sf):
    return turn_repair.repair(turn_repair.damaged(table(spark, sf, "conversations")))
