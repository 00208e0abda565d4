"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationflow.llm.conversations import repair_conversations
from stationflow.llm.decontaminate import find_benchmark
from stationflow.llm.jaccard_join import jaccard_components
from stationflow.llm.lattice_lm import score_documents
from stationflow.llm.mixing import mix_sources
from stationflow.llm.packing import pack_documents
from stationflow.llm.quality_rules import judge_quality
from stationflow.llm.secret_scan import secret_report
from stationflow.llm.shared import ship_package
from stationflow.llm.spelling import spelling_variants
from stationflow.llm.substring_dedup import remove_repeated_windows
from stationflow.llm.suffix_dedup import SHORTER, remove_repeated_bytes
from stationflow.llm.token_counts import count_tokens
from stationflow.llm.url_filter import blocked_hosts, filter_urls, with_host_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(_table(spark, sf_dir, "documents"), shorter=SHORTER)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, blocked_hosts(with_host_path(pages.select("url"))))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_lattice_lm": op4_lattice_lm,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_best_fit_packing": op13_best_fit_packing,
}

_HOST_PATH = """
  select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(substr(rest, 1 + length(regexp_extract(rest, '^[^/?#]*'))), '^[^?#]*'), '') as path
  from (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages)
"""

ORACLE_SQL = {
    "op3_url_filter": f"""
with u as ({_HOST_PATH}),
r(rule, h, p, v) as (values ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best as (
  select u.page_id, u.host, u.path, arg_max(rule, length(rule)) as rule, arg_max(v, length(rule)) as v
  from u left join r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p)
  group by all)
select page_id, host, path, rule,
  coalesce(v, case when list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
                   then 'block' else 'allow' end) as verdict
from best""",
    "op10_decontamination": r"""
with words as (
  select 'd' as kind, doc_id as id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
  union all
  select 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') from benchmark),
sh as (
  select distinct kind, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as s from words where len(w) >= 5
  union all
  select distinct kind, id, array_to_string(w, ' ') from words where kind = 'b' and len(w) between 1 and 4
  union all
  select distinct 'd', id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i+n-1], ' '))) as s
  from words, (select distinct len(w) as n from words where kind = 'b' and len(w) between 1 and 4) where kind = 'd' and len(w) >= n),
n as (select id, count(*) as n_item from sh where kind = 'b' group by id)
select d.id as doc_id, b.id as item_id, n.n_item, count(*) as n_shared, count(*) / n.n_item as containment
from sh d join sh b on d.s = b.s and d.kind = 'd' and b.kind = 'b' join n on n.id = b.id
group by d.id, b.id, n.n_item having count(*) * 100 >= n.n_item * 80""",
}
