"""The operators over the given tables, as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.llm import (decontaminate, filter_audit, lexical_search, line_crf, packing, page_text, pii, quality_rules,
                       secret_scan, sharding, simhash, suffix_dedup, token_counts)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; looked up on the driver, and the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(_documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.quality_rules(_documents(spark, sf_dir), labels, risk=0.02, error=0.05)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.quality_scores(_documents(spark, sf_dir), labels)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_documents(spark, sf_dir), width=3, distance=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"), limit=4096)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=0,
                        capacity=packing.Capacity(tokens=2048, documents=2048, attention=2048 ** 2))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_documents(spark, sf_dir), shards=8)


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_pii, op3_secrets, op4_quality_rules, op5_line_quality,
                                   op6_simhash, op7_decontamination, op8_token_counts, op9_packing, op10_shards,
                                   op11_page_text, op12_lexical_search, op13_filter_audit)}
# Every string of 100 bytes, told by the MD5 of its hexadecimal digits, with the place where it occurs first.
# Texts are cut into pieces of 100 starts, because a place far inside a long text is slow to reach.
_SQL_SUFFIX_DEDUP = """
with d as (
  select doc_id, coalesce(text, '') as t, hex(encode(coalesce(text, ''))) as h,
         octet_length(encode(coalesce(text, ''))) as n from documents),
c as (select doc_id, 100 * j as o, substr(h, 200 * j + 1, 398) as part, least(100, n - 99 - 100 * j) as m
      from (select doc_id, h, n, unnest(range(0, (n + 99) // 100)) as j from d) where n - 99 > 100 * j),
w as (select doc_id, o + i as s, md5_number(substr(part, 2 * i + 1, 200)) as k
      from (select doc_id, o, part, unnest(range(0, m)) as i from c)),
f as (select k, min({'d': doc_id, 's': s}) as first from w group by k having count(*) > 1),
r as (select w.doc_id, w.s from w join f using (k) where {'d': w.doc_id, 's': w.s} > f.first),
g as (select doc_id, s, sum(new) over (partition by doc_id order by s) as run
      from (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as new from r)),
runs as (select doc_id, min(s) as a, max(s) + 100 as b from g group by doc_id, run),
gaps as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as p from runs),
k as (select gaps.doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' order by a) as kept, max(b) as b,
             sum(b - a) as removed, count(*) as spans from gaps join d using (doc_id) group by gaps.doc_id)
select d.doc_id, n as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
       cast(coalesce(spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(b, 0) + 1))) as kept_sha256
from d left join k using (doc_id)
"""

# The given pages hold one plain article each, which patterns can cut out; references are those that occur in them.
_SQL_PAGE_TEXT = r"""
with a as (select row_number() over () as row, page_id, url,
                  string_split(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1),
                                              '</?(p|h1)>', chr(1), 'g'), chr(1)) as bs from pages),
b as (select row, unnest(bs) as b, generate_subscripts(bs, 1) as i from a),
c as (select row, i, trim(regexp_replace(replace(replace(replace(replace(replace(replace(
             regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&#39;', chr(39)), '&amp;', '&'),
             '[\s\x0B\x1C-\x1F\x{85}\pZ]+', ' ', 'g')) as c from b),
t as (select row, string_agg(c, chr(10) order by i) as t from c where c <> '' group by row)
select page_id, url, coalesce(t, '') as text, cast(length(coalesce(t, '')) as bigint) as n_chars from a left join t using (row)
"""

_SQL_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_SQL_LEXICAL_SEARCH = f"""
with d as (select * from (select row_number() over () as row, doc_id, {_SQL_TERMS} as ts from documents) where len(ts) > 0),
s as (select count(*) as n_docs, cast(sum(len(ts)) as bigint) as total from d),
i as (select row_number() over () as item, item_id, {_SQL_TERMS} as ts from benchmark),
q as (select item, t, count(*) as asked from (select item, unnest(ts) as t from i) group by item, t),
p as (select row, t, count(*) as tf from (select row, unnest(ts) as t from d) where t in (select t from q) group by row, t),
w as (select t, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
      from (select t, count(*) as df from p group by t), s),
r as (select item, row, cast(sum(asked * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(ts) * n_docs) // total))))
                             as bigint) as score
      from q join w using (t) join p using (t) join d using (row), s group by item, row),
k as (select item, doc_id, score, row_number() over (partition by item order by score desc, doc_id) as rank
      from r join d using (row) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from k join i using (item) where rank <= 10
"""

_SQL_FILTER_AUDIT = r"""
with w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
      from labels group by doc_id),
f as (select doc_id, part, case when len(ws) < 200 then 'A' else '' end
             || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
             || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end
             || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
             || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails from w),
c as (select part, fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
      from f left join l using (doc_id) group by part, fails),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from x a, x b, x c, x d, x e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
      from o, (select unnest([1, 2, 3, 4, 5]) as step)),
j as (select part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) as fail,
             translate(fails, before, '') = fails as reached from c, s),
g as (select part, filter_order, step, own, coalesce(sum(n) filter (reached and not fail), 0) as kept,
             coalesce(sum(n) filter (reached and fail), 0) as removed, coalesce(sum(n) filter (not reached and fail), 0) as redundant,
             coalesce(sum(n) filter (fails = own), 0) as unique_fails,
             coalesce(sum(good) filter (reached and fail), 0) as good_lost,
             coalesce(sum(toxic) filter (reached and fail), 0) as toxic_lost
      from j group by part, filter_order, step, own)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley from g
"""

ORACLES: dict[str, str] = {"op1_suffix_dedup": _SQL_SUFFIX_DEDUP, "op11_page_text": _SQL_PAGE_TEXT,
                           "op12_lexical_search": _SQL_LEXICAL_SEARCH, "op13_filter_audit": _SQL_FILTER_AUDIT}
