"""One query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_in_middle, licenses
from .chat import conversation_digests
from .exact_dedup import exact_groups
from .html_text import extract_main_text
from .merge_dropout import encode_with_dropout
from .packing import pack_documents
from .quality import quality_verdicts
from .simhash import near_groups
from .token_files import token_file_digests
from .token_alignment import align_tokens
from .toxicity import score_toxicity
from .url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_with_dropout(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), rate=0.1, seed=1, with_ids=False)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts hold what looks like control strings."""
    text, who = F.lit("\\### Assistant: </turn> ok"), F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), who.alias("role"), text.alias("text"))
    return conversation_digests(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_table(spark, sf_dir, "documents")).drop("js_class", "js_word")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents")).drop("first")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"), digests=True)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


_ALL = (op1_merge_dropout, op2_chat_formatting, op3_license_scan, op4_token_files, op5_exact_dedup, op6_quality_rules, op7_html_text, op8_packing, op9_toxicity, op10_simhash, op11_fill_in_middle, op12_token_alignment, op13_url_filter)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

#: Turns in order, their texts, the lengths of the template's marks and escapes, and references that became placeholders.
_OP2 = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, regexp_extract_all(text, '!\[[^\]\\<\n]*\]\([^)\\<\s]*\)') as refs from t),
m as (select *, len(refs) as n, len(list_filter(refs, lambda r: regexp_matches(r, '\.(mp3|wav|ogg|flac)\)$'))) as audio, len(list_filter(refs, lambda r: regexp_matches(r, '\.(pdf|doc|docx|txt)\)$'))) as docs from e),
c as (select *, length(replace(replace(role || text, '\', '\b'), '<', '\l')) + length('<turn><body></turn>') + 1
    - length(array_to_string(refs, '')) + audio * length('<audio>') + docs * length('<document>') + (n - audio - docs) * length('<image>') as chars from m)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars, cast(sum(n) as bigint) as n_attachments,
  cast(sum(128 * audio + 512 * docs + 256 * (n - audio - docs)) as bigint) as expanded_tokens
from c group by conv_id
"""

#: Deleting white space, grouping by the text itself and hashing are SQL; so is the choice of the row that stays.
_OP5 = r"""
select doc_id,
  first_value(doc_id) over (partition by t order by n desc, doc_id) as keep_id,
  count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by n desc, doc_id) = 1 as kept,
  sha256(t) as text_sha256
from (select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t from documents)
"""

ORACLES: dict[str, str] = {"op2_chat_formatting": _OP2, "op3_license_scan": licenses.oracle(), "op5_exact_dedup": _OP5, "op11_fill_in_middle": fill_in_middle.ORACLE}
