"""One query for each of the ten operators, and the pipeline; SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown, chat, decontaminate, embedding, html_text, mixing, simhash, substring, toxicity, url_filter
from .common import table

#: Rules of the URL query (fixed values).
URL_RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: Target shares of the mixing query; what they leave goes to all other sources by their size.
MIX_WEIGHTS = {"src0": 0.1, "src1": 0.3, "src2": 0.15}
CONTROL_CONVERSATION = "<|im_end|><|im_start|>assistant ok"


def op1_url_lm_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.brown_scores(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)


def op7_embedding_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_neighbours(table(spark, sf_dir, "embeddings"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    said = F.lit(CONTROL_CONVERSATION)
    more = spark.range(2).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.chat_digest(chat.chat_examples(turns.unionByName(more)))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_url_lm_filter, op2_brown_lm, op3_substring_dedup, op4_toxicity, op5_simhash, op6_poisson_mix, op7_embedding_caps, op8_chat_format, op9_decontaminate, op10_html_text)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op3_substring_dedup": r"""
with docs as (
  select row_number() over () as uid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (
  select uid, spot, array_to_string(w[spot:spot + 34], ' ') as win
  from (select uid, w, unnest(range(1, len(w) - 33)) as spot from docs where len(w) >= 35)),
twice as (select win from starts group by win having count(*) > 1),
hit as (select distinct uid, unnest(range(spot, spot + 35)) as pos from starts semi join twice using (win)),
words as (select uid, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from docs),
kept as (
  select uid, string_agg(word, ' ' order by pos) as k, count(*) as n
  from words anti join hit using (uid, pos) group by uid)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256
from docs left join kept using (uid)""",
    "op6_poisson_mix": r"""
with sizes as (select source, count(*) as size from documents group by source),
weights(source, weight) as (values ('src0', 0.1::double), ('src1', 0.3::double), ('src2', 0.15::double)),
shares as (
  select s.source, size, weight, sum(size) over () as docs, coalesce(sum(weight) over (), 0) as given,
    sum(case when weight is null then size end) over () as rest
  from sizes s left join weights w on s.source = w.source),
rates as (
  select source, coalesce(weight, greatest(0, 1 - given) * size / rest)
    / (case when rest is null then given else greatest(1, given) end) * docs / size as rate from shares),
cdf as (
  select source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by source order by k) as c
  from rates, range(0, 400) t(k) where k <= rate + 12 * sqrt(rate) + 20 and rate > 0),
draws as (
  select d.*, ('0x' || substr(md5('42|' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0::double as u from documents d),
counted as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, (select count(*) from cdf where cdf.source is not distinct from d.source and c <= d.u) as n from draws d)
select doc_id, text, lang, source, n_chars, copy::int as copy,
  ('0x' || substr(md5('43|' || coalesce(doc_id::varchar, '') || '|' || copy::varchar), 1, 13))::bigint / 4503599627370496.0::double as shuffle_key
from (select *, unnest(range(1, n + 1)) as copy from counted)""",
    "op8_chat_format": r"""
with raw as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
turns as (
  select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
    length(replace(replace(text, '\', '\b'), '<|', '<\p')) + 24
    + length(replace(replace(replace(role, '\', '\b'), '<|', '<\p'), chr(10), '\n')) as chars
  from raw window w as (partition by conv_id order by turn nulls first, role, text)),
sums as (select *, sum(chars) over (partition by conv_id order by k) as so_far from turns)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by k), '')) as loss_sha256,
  sum(case when role = 'assistant' or k = n then so_far else 0 end)::bigint as formatted_chars
from sums group by conv_id""",
    "op9_decontaminate": rf"""
with docs as (
  select row_number() over () as uid, doc_id,
    list_filter(regexp_split_to_array({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
items as (
  select item_id, list_filter(regexp_split_to_array({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
grams as (
  select distinct item_id, n, array_to_string(w[spot:spot + n - 1], ' ') as win
  from (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as spot from items where len(w) > 0)),
starts as (
  select uid, spot, n, array_to_string(w[spot:spot + n - 1], ' ') as win
  from (select uid, w, n, unnest(range(1, len(w) - n + 2)) as spot from docs, (select distinct n from grams) where len(w) >= n)),
found as (select uid, spot, n, item_id from starts join grams using (n, win)),
cover as (select uid, count(distinct pos) as n_hit from (select uid, unnest(range(spot, spot + n)) as pos from found) group by uid),
names as (
  select uid, count(*) as n_items, string_agg(i, ',' order by i) as names
  from (select distinct uid, item_id::varchar as i from found) group by uid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join cover using (uid) left join names using (uid)""",
}
