"""The registered queries of the operators of this subpackage, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, bpe, codes, importance, jaccard, langid, licences, maintext, materialise, mixing, suffix, topk, toxicity

RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(n: int, remainder: int):
    """Whether the CRC of the id as text has that remainder; rows without an id are never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == remainder, F.lit(False))


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents"), 50).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.materialise(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), 4, 85)


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", held_out(3, 1).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1)).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(documents.where(~F.col("held_out")), labels)
    return toxicity.score(documents, model).select("*", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(4, 2))
    learned = langid.learn(documents.where(~F.col("held_out")))
    return langid.identify(documents.select("doc_id", "held_out", "text"), learned)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


OP1_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as q from embeddings
  where vec_id is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
s as (
  select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select * from r where rank <= 20
"""

OP7_SQL = r"""
with rows as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null')), 1, 9))::bigint as h
  from documents),
sources as (select source, sum(size)::bigint as source_size from rows group by source),
ranked as (
  select *, 3 * source_size as most,
         ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight
  from sources),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(weight) over (order by most / weight, source nulls last rows between current row and unbounded following))::double as l
  from ranked),
level as (select max(l) filter (where l * weight <= most) as l from levels),
plan as (
  select source, source_size, coalesce(least(level.l * weight, most::double), most::double) as target
  from ranked, level),
epoch as (
  select *, case when source_size > 0 then least(floor(target / source_size), 3) else 0 end::bigint as epochs from plan),
bins as (
  select source, h, sum(size)::bigint as size, sum(sum(size)) over (partition by source order by h)::bigint as upto from rows group by source, h),
ends as (
  select e.source, max(case when size - (rest - (upto - size)) < rest - (upto - size) then h + 1 else h end) as lim
  from (select *, target - epochs * source_size as rest from epoch) e
  join bins b on b.source is not distinct from e.source
  where upto - size <= rest and rest < upto group by e.source)
select r.doc_id, r.size, e.source_size, e.target,
       r.size * (e.epochs + case when r.h < coalesce(x.lim, 0) then 1 else 0 end) as taken
from rows r join epoch e on r.source is not distinct from e.source
left join ends x on r.source is not distinct from x.source
"""

OP11_SQL = r"""
with crcs as (select list(list_reduce(range(8), lambda c, j: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i) order by i) as t from range(256) r(i)),
d as (select row_number() over () as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words from documents),
w as (select r, unnest(words) as word from d),
tw as (select unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
vocabulary as (select distinct word, hex(encode(word)) as x from (select word from w union all select word from tw)),
buckets as (
  select word, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::bigint), lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::int]), 4294967295::bigint), 4294967295) % 10000 as bucket
  from vocabulary, crcs),
s as (select bucket, count(*) as n from w join buckets using (word) group by bucket),
t as (select bucket, count(*) as n from tw join buckets using (word) group by bucket),
gains as (
  select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from w) + 10000)::double / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from tw) + 10000)::double)))::bigint as gain
  from s full join t using (bucket)),
weights as (select r, sum(gain)::bigint as weight from w join buckets using (word) join gains using (bucket) group by r),
scored as (
  select d.r, doc_id, len(words)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from d left join weights using (r)),
ranks as (
  select r, row_number() over (order by score desc, doc_id nulls last, n_features, weight) as rank, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= 10 * n // 100 then rank end as rank from scored left join ranks using (r)
"""


def _codes_sql(positions: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd's method written out: one common table expression each for a round's assignment and its codebooks."""
    steps = [f"""
books0 as (
  select p, row_number() over (partition by p order by vec_id nulls last, r) - 1 as e, x from parts
  where r in (select r from kept order by vec_id nulls last, r limit {entries}))"""]
    for i in range(rounds + 1):
        # |x - e|^2 without |x|^2, which is the same for all entries; all terms are integers, exact in doubles.
        steps.append(f"""
codes{i} as materialized (
  select r, p, arg_min(e, (list_inner_product(b.x, b.x) - 2 * list_inner_product(a.x, b.x)) * {entries} + e) as e
  from parts a join books{i} b using (p) group by r, p)""")
        if i < rounds:
            steps.append(f"""
sums{i} as (
  select p, e, k, floor(sum(x[k]) / count(*)) as c
  from (select r, p, c.e, x, unnest(range(1, len(x) + 1)) as k from codes{i} c join parts using (r, p)) group by p, e, k),
books{i + 1} as materialized (
  select p, e, coalesce(n.x, b.x) as x from books{i} b left join (select p, e, list(c order by k) as x from sums{i} group by p, e) n using (p, e))""")
    last = f"codes{rounds}", f"books{rounds}"
    return f"""
with kept as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as x from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
parts as materialized (
  select r, vec_id, p, x[p * (len(x) // {positions}) + 1 : (p + 1) * (len(x) // {positions})] as x from kept, range({positions}) t(p)),
{",".join(steps)},
coded as (
  select a.r, string_agg(lower(printf('%02x', c.e)), '' order by p) as code,
         sum(list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x))::bigint as error
  from parts a join {last[0]} c using (r, p) join {last[1]} b using (p, e) group by a.r),
sha as (select sha256(string_agg(array_to_string(list_transform(x, lambda c: c::bigint), ','), ',' order by p, e)) as codebooks_sha256 from {last[1]})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from kept join coded using (r), sha
"""


def _licence_sql() -> str:
    """Lines, whole texts and runs of words, each in common table expressions of its own."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = lambda pairs: f"[{', '.join(map(quoted, pairs))}]"
    rows = ", ".join(f"({quoted(k)}, {listed(licences.bigrams(t))})" for k, texts in licences.TEMPLATES.items() for t in texts)
    both = (licences.TEMPLATES, licences.PASSAGES)
    runs = ", ".join(f"({quoted(k)}, {len(licences._pairs(t))}, {listed(licences.bigrams(t))})" for m in both for k, texts in m.items() for t in texts)
    return rf"""
with t(licence, pairs) as (values {rows}),
d as (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as lines from documents),
u as (
  select r, i as line, list_filter(string_split(regexp_replace(lower(lines[i]), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') as w
  from (select r, lines, unnest(range(1, len(lines) + 1)) as i from d)
  union all
  select r, 0, list_filter(string_split(regexp_replace(lower(array_to_string(lines, chr(10))), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') from d),
p as (select r, line, len(w) - 1 as n, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) as own from u where len(w) between 2 and 400),
h as (
  select distinct r, line, licence, 2.0::double * len(list_intersect(own, pairs)) / (n + len(pairs)) as dice
  from p join t on 200 * least(n, len(pairs)) >= 80 * (n + len(pairs)) and 200 * len(list_intersect(own, pairs)) >= 80 * (n + len(pairs))),
-- Runs: pairs of words with their places in the text, those of a template, and the runs that begin with one of them.
tr(licence, long, pairs) as (select distinct * from (values {runs})),
tn as (select *, row_number() over () as t from tr),
tp as (select t, licence, long, len(pairs) as tn, unnest(pairs) as pair from tn),
whole as (select r, w, len(w) - 1 as n from u where line = 0),
pairs as (select r, n, i - 1 as pos, w[i] || ' ' || w[i + 1] as pair from (select *, unnest(range(1, len(w))) as i from whole)),
near as (select r, t, n, pos, pair, licence, long, tn from pairs join tp using (pair)),
possible as (select r, t from near group by r, t having 120 * count(distinct pair) >= 80 * any_value(tn)),
own as (select near.* from near semi join possible using (r, t)),
run as (
  select a.r, a.t, a.licence, a.long, a.pos, a.n, 2 * count(distinct b.pair) as c, least(a.long, a.n - a.pos) + a.tn as total
  from own a join own b on a.r = b.r and a.t = b.t and b.pos between a.pos and a.pos + a.long - 1 group by all),
good as (select *, c::double / total as dice from run where 100 * c >= 80 * total),
kept as (
  select * from good g where not exists (
    select 1 from good o where o.r = g.r and o.t = g.t and 2 * abs(o.pos - g.pos) < g.long and (o.dice > g.dice or (o.dice = g.dice and o.pos < g.pos)))),
words as (select r, line, sum(len(w)) over (partition by r order by line) as upto, len(w) as n from u where line > 0 and r in (select r from kept)),
placed as (
  select k.r, k.licence, k.dice, a.line as from_line, b.line as to_line
  from kept k join words a on a.r = k.r and k.pos >= a.upto - a.n and k.pos < a.upto
  join words b on b.r = k.r and least(k.pos + k.long, k.n) >= b.upto - b.n and least(k.pos + k.long, k.n) < b.upto),
outside as (
  select * from placed x where not exists (select 1 from h where h.r = x.r and (h.line = 0 or (x.from_line = x.to_line and h.line = x.from_line)))),
alls as (select r, dice, 1 as alone, line, licence from h union all select r, dice, 0, from_line, licence from outside),
b as (select r, first(licence order by dice desc, alone desc, line, licence) as licence, max(dice) as dice, first(line order by dice desc, alone desc, line, licence)::int as line_no from alls group by r),
noticed as (
  select r, line from h where line > 0
  union select r, from_line from outside x where not exists (select 1 from h where h.r = x.r and h.line between x.from_line and x.to_line)),
m as (select r, count(*)::int as n_notices from noticed group by r)
select doc_id, licence, dice, line_no, coalesce(n_notices, 0)::int as n_notices from d left join b using (r) left join m using (r)
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_top_k, op2_byte_bpe, op3_suffix_dedup, op4_training_order, op5_ngram_jaccard, op6_licence_scan, op7_mix_sources, op8_nearest_neighbours, op9_toxicity, op10_language_id, op11_importance_resampling,
        op12_vector_codes, op13_main_text,
    )
}
ORACLE = {"op1_exact_top_k": OP1_SQL, "op6_licence_scan": _licence_sql(), "op7_mix_sources": OP7_SQL, "op11_importance_resampling": OP11_SQL, "op12_vector_codes": _codes_sql()}
