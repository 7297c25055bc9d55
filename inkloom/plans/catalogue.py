"""Queries of the engine's own operators over the driver's tables, each with its SQL.

The driver has no images, so tables stand in: order lines are boxes on pages, embeddings are the coefficients of a
perceptual hash, documents are captions, events are logs and replies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions import bits, geometry, text
from inkloom.operators import dataset, dedup, panels
from inkloom.settings import Settings
from inkloom.sources import markers
from inkloom.sources.tables import load

SETTINGS = Settings()
PAGE = 400
HASH_DISTANCE = 20
STYLE_WORDS = ("the", "ist", "est", "ing")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "lineitem")
    return rows.select(
        F.col("l_orderkey").alias("page"),
        F.col("l_linenumber").alias("box_no"),
        (F.col("l_partkey") % 300 - 20).alias("x"),
        (F.col("l_suppkey") * 7 % 300 - 20).alias("y"),
        (F.col("l_quantity").cast("bigint") * 9).alias("w"),
        (F.col("l_partkey") % 37 * 10 + 20).alias("h"),
        F.lit(PAGE).cast("bigint").alias("page_w"),
        F.lit(PAGE).cast("bigint").alias("page_h"),
    )


RAW = """raw as (
  select l_orderkey as page, l_linenumber as box_no, l_partkey % 300 - 20 as x, l_suppkey * 7 % 300 - 20 as y,
    l_quantity::bigint * 9 as w, l_partkey % 37 * 10 + 20 as h from lineitem)"""
TRIMMED = f"""{RAW},
trimmed as (
  select page, box_no, greatest(x, 0) + 8 as x, greatest(y, 0) + 8 as y,
    least(x + w, 400) - 8 - (greatest(x, 0) + 8) as w, least(y + h, 400) - 8 - (greatest(y, 0) + 8) as h from raw),
boxes as (select * from trimmed where w > 0 and h > 0 and w * h >= 10000)"""


@query(f"with {TRIMMED} select page, (row_number() over (partition by page order by y, x, box_no) - 1)::int as idx, x, y, w, h from boxes")
def panel_boxes(spark, sf):
    return panels.panel_boxes(_boxes(spark, sf), SETTINGS)


ROUGH = "select l_orderkey as page, l_quantity::bigint * 9 as w, l_quantity::bigint * 9 as h from lineitem"
CLASSIFIED = f"""rough as ({ROUGH}),
found as (select page, count(*) as n, max(w * h) as largest from rough group by page),
judged as (
  select o_orderkey as page, coalesce(n, 0) as n,
    case when coalesce(n, 0) = 0 then 'no panels detected'
      when n > 2 then 'too many panels (' || n || ' > 2)'
      when n = 1 and largest >= 0.85 * 160000 then 'splash page (single full-page panel)' end as reason
  from orders left join found on page = o_orderkey)"""


def _classified(spark, sf):
    side = F.col("l_quantity").cast("bigint") * 9
    rough = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), side.alias("w"), side.alias("h"))
    pages = load(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), F.lit(PAGE).alias("page_w"), F.lit(PAGE).alias("page_h"))
    return panels.classify_pages(pages, rough, SETTINGS.having(max_panels=2))


@query(f"with {CLASSIFIED} select * from judged")
def classify_page(spark, sf):
    return _classified(spark, sf)


@query(f"with {CLASSIFIED} select 'panels' as stage, page::varchar as stem, reason from judged where reason is not null")
def quarantine(spark, sf):
    return panels.route(_classified(spark, sf), "panels")[1]


@query("""with axis as (select distinct user_id, floor(epoch(ts) / 3600)::bigint as i from events),
marked as (select *, case when i - lag(i) over w - 1 >= 8 then 1 else 0 end as new from axis window w as (partition by user_id order by i)),
numbered as (select *, sum(new) over (partition by user_id order by i rows unbounded preceding) as span from marked)
select user_id, min(i) as start, max(i) + 1 as stop from numbered group by user_id, span having max(i) + 1 - min(i) >= 3""")
def content_spans(spark, sf):
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)
    return panels.content_spans(load(spark, sf, "events").select("user_id", hour.alias("i")).distinct(), ["user_id"], 8, 3)


@query(f"""with {RAW},
spans as (
  select page, greatest(0, ceil(x / 20.0))::bigint as a, least(19, ceil((x + w) / 20.0) - 1)::bigint as b,
    greatest(0, ceil(y / 20.0))::bigint as c, least(19, ceil((y + h) / 20.0) - 1)::bigint as d from raw),
cells as (select distinct page, gx, gy from (select page, c, d, unnest(range(a, b + 1)) as gx from spans), range(0, 20) t(gy) where gy between c and d)
select page, count(*) as cells, count(*) / 400.0::double as coverage from cells group by page""")
def mask_union_coverage(spark, sf):
    return panels.coverage(panels.mask_rows(_boxes(spark, sf), 20, PAGE, PAGE), 400)


@query("""with c as (select o_orderkey as stem, floor(o_totalprice) / 500000 as coverage from orders)
select stem, round_even(coverage * 100, 0)::bigint::varchar || '%' as pct,
  case when coverage > 0.6 then 'excessive mask coverage (' || round_even(coverage * 100, 0)::bigint::varchar || '% > 60%)' end as reason from c""")
def coverage_pct(spark, sf):
    c = F.floor("o_totalprice").cast("double") / 500000
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("stem"), geometry.percent(c).alias("pct"), geometry.mask_reason(c, SETTINGS.max_mask_coverage).alias("reason"))


@query("""with s as (select p_partkey as stem, p_size * 10 as w, p_size * 10 + p_partkey % 50 as h from part)
select stem, case when least(w, h) >= 256 then w else round_even(w * (256.0::double / least(w, h)), 0) end::bigint as width,
  case when least(w, h) >= 256 then h else round_even(h * (256.0::double / least(w, h)), 0) end::bigint as height from s""")
def upscale_dims(spark, sf):
    w = F.col("p_size") * 10
    return load(spark, sf, "part").select(F.col("p_partkey").alias("stem"), geometry.upscaled(w, w + F.col("p_partkey") % 50, 256).alias("to")).select("stem", "to.width", "to.height")


HASHES = """elems as (select vec_id, embedding, unnest(range(1, 65)) as i from embeddings),
hashes as (
  select vec_id, bit_or(case when embedding[i]::double > (list_sort(embedding)[32]::double + list_sort(embedding)[33]::double) / 2 then 1::ubigint << (64 - i)::ubigint else 0::ubigint end) as u
  from elems group by vec_id)"""


def _hashes(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("ord"), bits.above_median_bits(F.transform("embedding", lambda v: v.cast("double"))).alias("h"))


@query(f"with {HASHES} select vec_id, lpad(to_hex(u), 16, '0') as phash from hashes")
def phash_bits(spark, sf):
    return _hashes(spark, sf).select(F.col("ord").alias("vec_id"), F.lpad(F.hex("h"), 16, "0").alias("phash"))


GREEDY = f"""with recursive {HASHES},
t as materialized (select row_number() over (order by vec_id) as rn, vec_id, u from hashes),
g(i, ids, ks) as (
  select 0::bigint, []::bigint[], []::ubigint[]
  union all
  select i + 1, case when len(list_filter(ks, lambda x: bit_count(xor(x, u)) < {HASH_DISTANCE})) = 0 then list_append(ids, vec_id) else ids end,
    case when len(list_filter(ks, lambda x: bit_count(xor(x, u)) < {HASH_DISTANCE})) = 0 then list_append(ks, u) else ks end
  from g join t on t.rn = g.i + 1),
kept as (select unnest(ids) as vec_id from g where i = (select max(i) from g))"""


@query(f"{GREEDY} select vec_id from kept")
def greedy_dedup(spark, sf):
    return dedup.greedy_dedup(_hashes(spark, sf), HASH_DISTANCE).select(F.col("ord").alias("vec_id"))


@query(f"{GREEDY} select vec_id from kept")
def greedy_dedup_rounds(spark, sf):
    """The way that is taken beyond a bounded number of rows."""
    return dedup.greedy_dedup(_hashes(spark, sf), HASH_DISTANCE, fold_rows=0).select(F.col("ord").alias("vec_id"))


COPIED = f"""with {HASHES}, both_ as (select vec_id as ord, u from hashes union all
  select vec_id + 1000000, xor(u, case when vec_id % 3 = 0 then 1048575::ubigint else (1::ubigint << (vec_id % 61)::ubigint) | (1::ubigint << (vec_id * 7 % 59)::ubigint) end) from hashes)"""


@query(f"""{COPIED} select x.ord as a, y.ord as b from both_ x join both_ y on x.ord < y.ord and bit_count(xor(x.u, y.u)) < 12""")
def band_candidates(spark, sf):
    """Of hashes and copies of them that differ in one or two bits, or in twenty, which no pair has within the bound."""
    rows = _hashes(spark, sf)
    flips = F.when(F.col("ord") % 3 == 0, F.lit(1048575).cast("bigint")).otherwise(F.expr("shiftleft(1L, cast(ord % 61 as int)) | shiftleft(1L, cast(ord * 7 % 59 as int))"))
    copies = rows.select((F.col("ord") + 1000000).alias("ord"), F.col("h").bitwiseXOR(flips).alias("h"))
    return dedup.close_pairs(rows.unionByName(copies), 12)


@query(f"""{GREEDY}, sized as (select vec_id * 7 % 600 as s from kept),
c as (select count(*) filter (s >= 256) as kept, (select count(*) from embeddings) - count(*) as deduped, count(*) filter (s < 256) as dropped_small, count(*) filter (s >= 256 and s < 400) as upscaled from sized)
select *, 'clean: kept ' || kept || ', deduped ' || deduped || ', dropped-small ' || dropped_small || ', upscaled ' || upscaled as line from c""")
def clean_report(spark, sf):
    rows = _hashes(spark, sf)
    return dataset.clean_report(dedup.greedy_dedup(rows, HASH_DISTANCE), rows, F.col("ord") * 7 % 600, SETTINGS.min_side_px, 400)


@query("""with r as materialized (select row_number() over () as uid, doc_id, string_split(coalesce(text, ''), ' ') as l from documents),
w as (select uid, unnest(l) as x, unnest(range(1, len(l) + 1)) as p from r),
f as (select uid, x, min(p) as p from w where lower(x) <> 'the' group by uid, x),
k as (select uid, string_agg(x, ', ' order by p) as c from f group by uid)
select doc_id, 'The' || coalesce(', ' || c, '') as caption from r left join k using (uid)""")
def caption_tags(spark, sf):
    """All words of a text are tags."""
    tags = F.split(F.coalesce("text", F.lit("")), " ")
    return load(spark, sf, "documents").select("doc_id", text.build_caption(F.lit("The"), tags).alias("caption"))


@query(r"""with o as (select doc_id, coalesce(lang, '') as t, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) as l from documents)
select doc_id, rtrim(t || ', ' || case when starts_with(lower(l), lower(t)) then ltrim(l[len(t) + 1:], ' ,') else l end) as caption from o""")
def normalize_caption(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.normalize_caption(F.col("text"), F.coalesce("lang", F.lit(""))).alias("caption"))


@query("select vec_id as stem, list_transform(list_filter(range(1, 65), lambda i: i % 3 = 0 and embedding[i]::double >= 0.1), lambda i: 'tag_' || i) as tags from embeddings")
def select_tags(spark, sf):
    names = F.array(*[F.lit(f"tag_{i}") for i in range(1, 65)])
    general = F.array(*[F.lit(i % 3 == 0) for i in range(1, 65)])
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("stem"), text.select_tags(F.col("embedding"), names, general, 0.1).alias("tags"))


@query("select event_id, (props ->> '$.k')::bigint as k from events")
def proxy_payload(spark, sf):
    reply = F.to_json(F.array(F.to_json(F.struct(F.get_json_object("props", "$.k").alias("caption")))))
    return load(spark, sf, "events").select("event_id", text.service_reply(reply)["caption"].cast("bigint").alias("k"))


@query("""select event_id, case event_id % 4 when 0 then 'empty_response' when 1 then 'parse_failed' when 2 then 'http_503' end as error from events""")
def proxy_errors(spark, sf):
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, F.lit("")).when(kind == 1, F.lit("no json")).when(kind == 2, F.lit('["{\\"error\\": \\"http_503\\"}"]')).otherwise(F.lit('["{\\"caption\\": \\"x\\"}"]'))
    return load(spark, sf, "events").select("event_id", text.service_reply(raw)["error"].alias("error"))


@query("""with e as (select event_id, case event_id % 5 when 0 then 'http_429' when 1 then 'http_404' when 2 then '' when 3 then 'parse_failed' end as error from events)
select event_id, coalesce(error, '') <> '' and (not starts_with(error, 'http_4') or error = 'http_429') as retry from e""")
def transient_errors(spark, sf):
    codes = F.element_at(F.array(*map(F.lit, ("http_429", "http_404", "", "parse_failed", None))), (F.col("event_id") % 5 + 1).cast("int"))
    return load(spark, sf, "events").select("event_id", text.worth_retrying(codes).alias("retry"))


@query("""select doc_id, lang, coalesce(trim(quality::varchar), source) as caption from documents left join labels using (doc_id)""")
def sidecar_caption(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source")
    return dataset.with_sidecar(docs, load(spark, sf, "labels"), "doc_id", "quality", F.col("source")).drop("source")


@query("select doc_id from documents anti join labels using (doc_id)")
def unlabelled(spark, sf):
    return dataset.without(load(spark, sf, "documents").select("doc_id"), load(spark, sf, "labels"), "doc_id")


@query("""select o_orderkey as stem, l_partkey, l_linenumber from orders join
(select l_orderkey, l_partkey, l_linenumber from lineitem qualify row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) = 1) on l_orderkey = o_orderkey""")
def first_match(spark, sf):
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("stem"), "l_partkey", "l_linenumber")
    return dataset.first_match(load(spark, sf, "orders").select(F.col("o_orderkey").alias("stem")), lines, "stem", "l_linenumber", ["l_partkey", "l_linenumber"])


@query("select item_id as row, weight from benchmark, (values (0.0::double), (0.4::double), (0.6::double), (0.8::double), (1.0::double)) w(weight)")
def eval_grid(spark, sf):
    return dataset.grid(load(spark, sf, "benchmark").select(F.col("item_id").alias("row")), (0, 0.4, 0.6, 0.8, 1))


@query("""select user_id, count(*) filter (event_id % 3 = 0) as failed, count(*) filter (event_id % 3 <> 0) as written,
coalesce((list('e' || event_id order by event_id) filter (event_id % 3 = 0))[1:10], []) as errors from events group by user_id""")
def recaption_result(spark, sf):
    error = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("e"), F.col("event_id").cast("string")))
    return dataset.recaption_result(load(spark, sf, "events").withColumn("error", error), ["user_id"], "event_id", "error")


@query("""select user_id, count(*) filter (event_id % 3 = 0) as failed, count(*) filter (event_id % 3 <> 0) as written,
coalesce((list('e' || event_id order by event_id) filter (event_id % 3 = 0))[1:3], []) as errors from events group by user_id""")
def recaption_shown(spark, sf):
    """All errors are counted, the first three are shown."""
    error = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("e"), F.col("event_id").cast("string")))
    return dataset.recaption_result(load(spark, sf, "events").withColumn("error", error), ["user_id"], "event_id", "error", most=3)


@query("""select path from (select doc_id, 'set/d' || doc_id || case doc_id % 4 when 0 then '.png' when 1 then '.JPG' when 2 then '.txt' else '' end as path from documents)
where doc_id % 3 = 0 and doc_id % 4 < 2""")
def chosen_files(spark, sf):
    """Names come with folders of either kind, twice, and some of files that aren't images."""
    n = F.col("doc_id")
    kind = F.when(n % 4 == 0, ".png").when(n % 4 == 1, ".JPG").when(n % 4 == 2, ".txt").otherwise("")
    files = load(spark, sf, "documents").select("doc_id", F.concat(F.lit("set/d"), n.cast("string"), kind).alias("path"))
    names = files.where(n % 3 == 0).select(F.explode(F.array(F.concat(F.lit("../"), "path"), F.concat(F.lit("a\\"), text.file_name(F.col("path"))))).alias("name"))
    return dataset.chosen(files.select("path"), names)


@query(r"""select lang, count(*) as n, count(*) filter (not starts_with(coalesce(text, ''), 'The')) as not_leading,
count(*) filter (regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(the|ist|est|ing)($|[^\p{L}\p{N}_])')) as leaks from documents group by lang""")
def dataset_gates(spark, sf):
    return dataset.gates(load(spark, sf, "documents"), ["lang"], "text", F.lit("The"), STYLE_WORDS)


@query("""select event_id, case when k = 1 then (event_id % 900)::int end as step, case when k = 1 then 2000 end as total_steps,
case k when 0 then (event_id % 7)::int when 3 then 3 end as epoch, case k when 0 then 10 when 3 then 4 end as total_epochs,
case when k = 1 and event_id % 8 <> 5 then ('0.' || event_id % 90)::double end as loss from (select event_id, event_id % 5 as k from events)""")
def parse_progress(spark, sf):
    """Epoch lines, a training bar with and without a loss, a caching bar, an epoch line with a bar, and noise."""
    e = F.col("event_id")
    word = lambda c: c.cast("string")
    loss = F.when(e % 8 == 5, F.lit("-")).otherwise(F.concat(F.lit("0."), word(e % 90)))
    line = (
        F.when(e % 5 == 0, F.concat(F.lit("epoch "), word(e % 7), F.lit("/10")))
        .when(e % 5 == 1, F.concat(F.lit("steps:  10%|#  | "), word(e % 900), F.lit("/2000 [01:30<13:30, 2.1it/s, avr_loss="), loss, F.lit("]")))
        .when(e % 5 == 2, F.concat(F.lit("caching latents:  50%|###  | "), word(e % 50), F.lit("/100 [00:01<00:02, 30it/s]")))
        .when(e % 5 == 3, F.lit("epoch 3/4 steps: 5/9 [00:01, avr_loss=0.5]"))
        .otherwise(F.lit("avr_loss=0.5 without a bar"))
    )
    return load(spark, sf, "events").select("event_id", text.training_progress(line).alias("p")).select("event_id", "p.*")


PHASES = "case turn % 4 when 0 then 'running' when 1 then 'done' when 2 then 'skipped' else 'error' end"


@query(f"""with t as (select conv_id, turn + 1 as idx, count(*) over (partition by conv_id) as total, coalesce(role, '') as name, {PHASES} as phase, length(coalesce(text, '')) as produced from conversations)
select conv_id, idx, (idx - 1 + case when phase = 'running' then 0.0::double else 1.0::double end) / total as fraction,
  '[' || idx || '/' || total || '] ' || name || ': ' || case phase when 'running' then 'running' when 'done' then 'done (' || produced || ' produced)' when 'skipped' then 'skipped (off)' else 'error: off' end as line from t""")
def progress_fraction(spark, sf):
    from pyspark.sql.window import Window

    turns = load(spark, sf, "conversations")
    total = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    phase = F.element_at(F.array(*map(F.lit, ("running", "done", "skipped", "error"))), (F.col("turn") % 4 + 1).cast("int"))
    rows = turns.select("conv_id", (F.col("turn") + 1).alias("idx"), total.alias("total"), F.coalesce("role", F.lit("")).alias("name"), phase.alias("phase"), F.char_length(F.coalesce("text", F.lit(""))).alias("produced"))
    return rows.select("conv_id", "idx", text.progress_fraction(F.col("idx"), F.col("total"), F.col("phase")).alias("fraction"), text.progress_line(F.col("idx"), F.col("total"), F.col("name"), F.col("phase"), F.col("produced"), F.lit("off")).alias("line"))


SUMMARY = ("region", "nation", "documents", "pages", "labels")


@query(" union all ".join(f"select '{t.ljust(9)}' as label, count(*) as n from {t}" for t in SUMMARY))
def run_summary(spark, sf):
    return dataset.run_summary({t: load(spark, sf, t) for t in SUMMARY})


@query("""with e as (select vec_id, embedding as v, list_reverse(embedding) as r from embeddings)
select vec_id, list_transform(range(1, 65), lambda i: case when abs(trunc(v[i]::double * 1000)::int) > 127 then trunc(r[i]::double * 1000)::int else trunc(v[i]::double * 1000)::int end) as pixels from e""")
def composite(spark, sf):
    scaled = F.transform("embedding", lambda v: (v.cast("double") * 1000).cast("int"))
    return load(spark, sf, "embeddings").select("vec_id", dataset.composite(scaled, F.reverse(scaled), F.transform(scaled, lambda v: F.abs(v))).alias("pixels"))


@query("""with n as (select url, string_split(split_part(url, '?', 1), '/')[-1] as name from pages),
d as (select *, length(name) - position('.' in reverse(name)) + 1 as dot from n)
select url, name, case when position('.' in name) > 0 and dot > 1 then name[:dot - 1] else name end as stem,
  case when position('.' in name) > 0 and dot > 1 then lower(name[dot + 1:]) else '' end as suffix,
  coalesce(position('.' in name) > 0 and dot > 1 and list_contains(['png', 'jpg', 'jpeg', 'webp', 'bmp'], lower(name[dot + 1:])), false) as is_image from d""")
def file_names(spark, sf):
    path = F.substring_index("url", "?", 1)
    return load(spark, sf, "pages").select("url", text.file_name(path).alias("name"), text.stem(path).alias("stem"), text.suffix(path).alias("suffix"), text.is_image(path).alias("is_image"))


@query("""select event_id, list_filter(list_transform(string_split(event_type || ', ,' || user_id::varchar || ' ', ','), lambda v: trim(v)), lambda v: v <> '') as items from events""")
def comma_list(spark, sf):
    return load(spark, sf, "events").select("event_id", text.comma_list(F.concat("event_type", F.lit(", ,"), F.col("user_id").cast("string"), F.lit(" "))).alias("items"))


@query("""select item_id as file, 0 as block, 'b' || item_id as id, case when item_id % 3 = 0 then ['missing required field: title'] when item_id % 3 = 1 then ['invalid status lost'] else []::varchar[] end as errors
from benchmark where item_id % 4 <> 3""")
def marker_extract(spark, sf):
    found = _markers(spark, sf)
    return found.select(F.col("file").cast("bigint").alias("file"), "block", F.col("fields")["id"].alias("id"), "errors")


@query("select count(*) as markers, count(*) filter (item_id % 3 <> 2) as errored from benchmark where item_id % 4 <> 3")
def marker_counts(spark, sf):
    return markers.marker_counts(_markers(spark, sf))


@query("""select '{"file":"' || item_id || '","block":"0","id":"b' || item_id || '"' || case when item_id % 3 <> 0 then ',"title":"T"' else '' end
|| ',"status":"' || case when item_id % 3 = 1 then 'lost' else 'draft' end || '"}' as value from benchmark where item_id % 4 <> 3""")
def marker_export(spark, sf):
    return markers.marker_json(_markers(spark, sf))


@query("""select item_id || '.md' as file, 0 as block, 'b' as id from benchmark where item_id % 2 = 0
union all select item_id || '.py', k, id from benchmark, (values (0, 'a'), (1, 'b')) t(k, id) where item_id % 2 <> 0""")
def marker_fences(spark, sf):
    """A fenced block and a plain one: the fence counts in ``.md`` files alone."""
    n = F.col("item_id")
    block = "<START>\nid: {}\ntitle: T\nstatus: draft\n<END>\n"
    body = F.concat(F.lit("```\n" + block.format("a") + "```\n" + block.format("b")), F.coalesce("text", F.lit("")))
    files = load(spark, sf, "benchmark").select(F.concat(n.cast("string"), F.when(n % 2 == 0, ".md").otherwise(".py")).alias("file"), body.alias("text"))
    found = markers.extract_blocks(files, "<START>", "<END>", ("id", "title", "status"), ("id", "title", "status"), ("draft", "final"))
    return found.select("file", "block", F.col("fields")["id"].alias("id"))


def _markers(spark, sf):
    n = F.col("item_id")
    title = F.when(n % 3 == 0, "").otherwise("title: T\n")
    status = F.when(n % 3 == 1, "status: lost\n").otherwise("status: draft\n")
    ident = F.when(n % 4 == 3, "").otherwise(F.concat(F.lit("id: b"), n.cast("string"), F.lit("\n")))
    body = F.concat(F.lit("x\n<START>\n"), ident, title, status, F.lit("<END>\n"), F.coalesce("text", F.lit("")))
    files = load(spark, sf, "benchmark").select(n.cast("string").alias("file"), body.alias("text"))
    return markers.extract_blocks(files, "<START>", "<END>", ("id", "title", "status", "tags"), ("id", "title", "status"), ("draft", "final"))


@query("select bool_and(length(r_name) > 3) as ok, max(length(r_name)) as width from region")
def doctor_verdict(spark, sf):
    return dataset.all_good(load(spark, sf, "region").select(F.col("r_name").alias("name"), (F.char_length("r_name") > 3).alias("ok")))


@query("select event_id, case when event_id % 5 <> 0 then props end as last from events")
def last_reply(spark, sf):
    """The last payload of an event stream that is neither empty nor null."""
    said = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("data: {}\nevent: x\ndata:"), F.col("props"), F.lit(" \n"))).otherwise(F.lit("event: data: y\n"))
    return load(spark, sf, "events").select("event_id", text.last_data_line(F.concat(said, F.lit("data: null\n\ndata:\n"))).alias("last"))


@query("""select event_id, case event_id % 7 when 0 then 'a' when 1 then 'b' when 2 then 'c' when 3 then 'd' end as caption,
case event_id % 7 when 1 then 5 end::bigint as in_tokens, case event_id % 7 when 4 then 'parse_failed' when 6 then 'empty_response' end as error from events""")
def reply_shapes(spark, sf):
    """All forms of a reply: a list with JSON text, an object, JSON text, a list with an object; a number, an empty list, blanks."""
    forms = ['["{\\"caption\\": \\"a\\"}"]', '{"caption": "b", "in_tokens": 5}', '"{\\"caption\\": \\"c\\"}"', '[{"caption": "d"}]', "17", "[]", " "]
    raw = F.element_at(F.array(*map(F.lit, forms)), (F.col("event_id") % 7 + 1).cast("int"))
    return load(spark, sf, "events").select("event_id", text.service_reply(raw).alias("r")).select("event_id", "r.caption", "r.in_tokens", "r.error")


@query("""select page_id, '{"data":["m","p","' || to_base64(encode(url)) || '"]}' as body, url_encode(url) as part from pages""")
def service_request(spark, sf):
    return load(spark, sf, "pages").select("page_id", text.request_body(F.lit("m"), F.lit("p"), F.encode("url", "utf-8")).alias("body"), text.url_part(F.col("url")).alias("part"))


READY_AT = "2030-01-01 00:00:00"


@query(f"""with f as (select lang, 'x/d' || doc_id || case doc_id % 2 when 0 then '.png' else '.txt' end as path, text, timestamp '2029-12-31 23:00:00' + to_minutes((doc_id % 60)::bigint) as modified from documents
  union all select distinct lang, 'x/.stage_complete', null, timestamp '2029-12-31 23:00:00' from documents where lang <> 'de'),
g as (select lang, bool_or(path = 'x/.stage_complete') as complete, count(*) filter (path[-3:] = 'png') as images, count(*) filter (path[-3:] = 'txt') as captions,
  count(*) filter (path[-3:] = 'txt' and not starts_with(coalesce(text, ''), 'T')) as not_leading, max(modified) <= timestamp '{READY_AT}' - interval 20 minutes as quiet,
  count(*) filter (path[-3:] = 'txt' and regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(the|ist|est|ing)($|[^\\p{{L}}\\p{{N}}_])')) as leaks from f group by lang)
select *, complete and images >= 20 and images = captions and not_leading = 0 and quiet as ready from g""".replace("\\\\", "\\"))
def dataset_readiness(spark, sf):
    docs = load(spark, sf, "documents")
    kind = F.when(F.col("doc_id") % 2 == 0, ".png").otherwise(".txt")
    start = F.lit("2029-12-31 23:00:00").cast("timestamp")
    files = docs.select("lang", F.concat(F.lit("x/d"), F.col("doc_id").cast("string"), kind).alias("path"), "text", (start + F.make_dt_interval(mins=(F.col("doc_id") % 60).cast("int"))).alias("modified"))
    marks = docs.where("lang <> 'de'").select("lang").distinct().select("lang", F.lit("x/.stage_complete").alias("path"), F.lit(None).cast("string").alias("text"), start.alias("modified"))
    return dataset.readiness(files.unionByName(marks), ["lang"], F.lit("T"), STYLE_WORDS, F.lit(READY_AT).cast("timestamp"))


@query("""select user_id, max(event_type || '-' || lpad(event_id::varchar, 9, '0')) as last, arg_max(event_type || '-' || lpad(event_id::varchar, 9, '0'), (ts, event_type || '-' || lpad(event_id::varchar, 9, '0'))) as newest from events group by user_id""")
def last_checkpoint(spark, sf):
    path = F.concat("event_type", F.lit("-"), F.lpad(F.col("event_id").cast("string"), 9, "0"))
    return dataset.newest(load(spark, sf, "events").select("user_id", path.alias("path"), F.col("ts").alias("modified")), ["user_id"])


@query("""select path from (select case doc_id % 4 when 0 then 'src/agents/' when 1 then 'src/other/' when 2 then 'agents/x/' else 'src/agents/__init__.py/' end || case when doc_id % 5 = 0 then '__init__' else 'm' || doc_id end
  || case when doc_id % 7 = 0 then '.md' else '.py' end as path, text, doc_id from documents)
where doc_id % 4 <> 1 and doc_id % 7 <> 0 and doc_id % 5 <> 0 and position('The' in coalesce(text, '')) = 0""")
def instrumentation_lint(spark, sf):
    n = F.col("doc_id")
    folder = F.element_at(F.array(*map(F.lit, ("src/agents/", "src/other/", "agents/x/", "src/agents/__init__.py/"))), (n % 4 + 1).cast("int"))
    name = F.when(n % 5 == 0, "__init__").otherwise(F.concat(F.lit("m"), n.cast("string")))
    files = load(spark, sf, "documents").select(F.concat(folder, name, F.when(n % 7 == 0, ".md").otherwise(".py")).alias("path"), "text")
    return dataset.lacking(files, ("handlers", "adapters", "agents", "engines"), "The")


WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(rf"""with f as (select doc_id, chr(9) || ' a' || chr(160) || chr(13) || chr(10) || chr(12288) || chr(10) || coalesce(text, '') || chr(9) as content from documents)
select doc_id, list_filter(list_transform(regexp_split_to_array(content, '[\n-\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]+'), lambda x: regexp_replace(x, '^{WHITE}|{WHITE}$', '', 'g')), lambda x: x <> '') as prompts from f""")
def prompt_lines(spark, sf):
    content = F.concat(F.lit("\t a\u00a0\r\n\u3000\n"), F.coalesce("text", F.lit("")), F.lit("\t"))
    return load(spark, sf, "documents").select("doc_id", text.prompts(content).alias("prompts"))


@query("select c_custkey as id, replace(replace('a %PROMPT% by %NAME%', '%PROMPT%', c_mktsegment), '%NAME%', c_name) as graph from customer")
def fill_template(spark, sf):
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), text.fill_template(F.lit("a %PROMPT% by %NAME%"), {"PROMPT": F.col("c_mktsegment"), "NAME": F.col("c_name")}).alias("graph"))


@query("""select p_partkey as stem, greatest(1, trunc(p_retailprice / 100 - 12)::int) as repeats, greatest(x1, 0)::int as x1 from (select *, least(p_size - 10, 5) as x1 from part)""")
def settings_clamps(spark, sf):
    corner = geometry.sorted_corners(F.struct((F.col("p_size") - 10).alias("x1"), F.lit(0).alias("y1"), F.lit(5).alias("x2"), F.lit(1).alias("y2")))
    return load(spark, sf, "part").select(F.col("p_partkey").alias("stem"), geometry.at_least(F.col("p_retailprice") / 100 - 12, 1).alias("repeats"), geometry.at_least(corner["x1"], 0).alias("x1"))
