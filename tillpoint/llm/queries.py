"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each runs its operator over its whole table with the operator's own parameters;
the columns that a query returns are derived from the operator's results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm import ann, chat, langid, linededup, mixing, phrases, pieces, quality, sharding, simhash, substring, vectorcodes, warc
from tillpoint.llm.common import table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


@register("op1_warc", """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, strlen(body)::bigint as payload_bytes, sha1(body) as payload_digest from p),
g as (select payload_digest, payload_bytes, max(page_id) as top from d where payload_bytes >= 1000 group by all)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when top is null or top = d.page_id then 'response' else 'revisit' end as record_type,
       case when top <> d.page_id then top end as refers_to
from d left join g on d.payload_digest = g.payload_digest and d.payload_bytes = g.payload_bytes
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_pages(table(spark, sf_dir, "pages"))
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       page("refers_to").alias("refers_to"))


@register("op2_neighbours")
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@register("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})


@register("op4_mixing", """
with recursive d as (select doc_id, source, coalesce(text, '') as text from documents),
s as (select source, sum(strlen(text) + 1)::double as size from d group by source),
w as (select source, size, sqrt(size) as weight from s),
r as (select source, round(weight / (select sum(weight) from w) * (select sum(size) from w) / size, 6) as rate from w),
m as (select source, rate, greatest(1, ceil(rate / 16.0))::int as draws from r),
c(source, k, p, cum) as (
  select source, 0, exp(-(rate / draws)), exp(-(rate / draws)) from m
  union all
  select c.source, k + 1, p * (rate / draws) / (k + 1), cum + p * (rate / draws) / (k + 1)
  from c join m on c.source is not distinct from m.source where k < 80),
cdf as (select source, list(cum) as cums from c group by source),
u as (select doc_id, d.source, rate, strlen(text)::bigint as n_bytes, coalesce(doc_id::varchar, '') || ':' || md5(text) as who, unnest(range(1, draws + 1)) as part
      from d join m on d.source is not distinct from m.source),
x as (select doc_id, u.source, rate, n_bytes, who, part,
             len(list_filter(cums, lambda z: z <= ('0x' || substr(md5('11:' || part::varchar || ':' || who), 1, 13))::bigint::double / 4503599627370496.0)) as n
      from u join cdf on u.source is not distinct from cdf.source),
t as (select doc_id, source, rate, n_bytes, who, sum(n)::int as n_copies from x group by all)
select doc_id, source, rate, n_copies, unnest(range(1, n_copies + 1))::int as copy, n_bytes from t where n_copies > 0
""")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    # measured on the shuffled copies, so the texts travel
    return mixed.select("doc_id", "source", "rate", "n_copies", "copy", F.octet_length(text_of(mixed, "text")).cast("long").alias("n_bytes"))


@register("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coder = pieces.SentencePiece(spark)
    coded = docs.select("doc_id", coder.encode_verified(F.col("text")).alias("c"))
    return coded.select("doc_id", F.size("c.token_ids").cast("long").alias("n_tokens"), "c.token_ids", "c.decodes")


@register("op6_line_dedup", """
with t as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select rid, unnest(ls) as line, generate_subscripts(ls, 1) as pos from t),
k as (select rid, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where length(key) >= 1 group by key having count(distinct rid) >= 10),
m as (select rid, pos, line, k.key in (select key from f) as gone from k),
o as (select rid, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
             coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as kept from m group by rid)
select t.doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from o join t using (rid)
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return langid.identify(docs, ~held_out, {"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(False))})


def _quality_sql() -> str:
    sym, dup, chars = (quality.FENCES[m] for m in ("symbols_per_word", "dup_line_share", "mean_word_chars"))
    g, k = quality.GAMMA, quality.PRIOR
    spaces = r"\x20\x09-\x0D"
    return rf"""
with d as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select rid, unnest(words) as word, generate_subscripts(words, 1) as pos
      from (select rid, regexp_extract_all(text, '[^{spaces}]+') as words from d)),
five as (select rid, pos, word, lead(pos, 4) over o is not null as full5,
                word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o || ' ' || lead(word, 4) over o as win
         from w window o as (partition by rid order by pos)),
rep as (select rid, pos, word, full5 and count(*) over (partition by rid, win) > 1 as twice from five),
cov as (select rid, word, max(case when twice then 1 else 0 end) over (partition by rid order by pos rows between 4 preceding and current row) as covered from rep),
a as (select rid, count(*) as n_words, sum(length(word))::bigint as word_chars, sum(covered)::bigint as n_repeat_words from cov group by rid),
ln as (select rid, unnest(string_split(text, chr(10))) as line from d),
b as (select rid, count(*) as n_lines, (count(*) - count(distinct line))::bigint as n_dup_lines from ln where regexp_matches(line, '[^{spaces}]') group by rid),
m as (select d.rid, doc_id, lang, source, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines
      from d left join a using (rid) left join b using (rid)),
r as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, n_symbols / greatest(n_words, 1)::double as sym,
             n_dup_lines / greatest(n_lines, 1)::double as dup, word_chars / greatest(n_words, 1)::double as chars from m),
vals as (select lang, source, metric, x from (
           select lang, source, 's' as metric, sym as x from r where not base_failed
           union all select lang, source, 'd', dup from r where not base_failed
           union all select lang, source, 'c', chars from r where not base_failed)),
sk as (select lang, source, metric, case when x <= 1e-9 then {quality.TINY} else ceil(ln(x) / ln({g}))::int end as bucket, count(*) as n from vals group by all),
lv as (select 1 as lvl, lang, source, metric, bucket, n from sk
       union all select 2, lang, null, metric, bucket, sum(n) from sk group by lang, metric, bucket
       union all select 3, null, null, metric, bucket, sum(n) from sk group by metric, bucket),
run as (select *, sum(n) over (partition by lvl, lang, source, metric order by bucket) as cum, sum(n) over (partition by lvl, lang, source, metric) as total,
               case when bucket = {quality.TINY} then 0.0 else 2.0 / ({g} + 1.0) * pow({g}::double, bucket::double) end as v from lv),
q as (select lvl, lang, source, metric, max(total) as total, min(v) filter (cum >= ceil(0.25 * total)) as q25,
             min(v) filter (cum >= ceil(0.5 * total)) as q50, min(v) filter (cum >= ceil(0.75 * total)) as q75 from run group by all),
ql as (select g.lang, a.metric, {", ".join(f"(coalesce(o.total, 0) * coalesce(o.{x}, 0.0::double) + {k} * a.{x}) / (coalesce(o.total, 0) + {k}) as {x}" for x in ("q25", "q50", "q75"))}
       from (select distinct lang from r) g cross join (select * from q where lvl = 3) a
            left join (select * from q where lvl = 2) o on g.lang is not distinct from o.lang and a.metric = o.metric),
qp as (select g.lang, g.source, a.metric, {", ".join(f"(coalesce(o.total, 0) * coalesce(o.{x}, 0.0::double) + {k} * a.{x}) / (coalesce(o.total, 0) + {k}) as {x}" for x in ("q25", "q50", "q75"))}
       from (select distinct lang, source from r) g join ql a on g.lang is not distinct from a.lang
            left join (select * from q where lvl = 1) o on g.lang is not distinct from o.lang and g.source is not distinct from o.source and a.metric = o.metric),
pick as (select lang, source, metric, struct_pack(q25 := q25, q50 := q50, q75 := q75) as t from qp),
f as (select lang, source,
             max(t.q50 + greatest(t.q50 - t.q25, {sym[0]}) * {sym[2]}) filter (metric = 's') as hi_s,
             max(t.q50 + greatest(t.q50 - t.q25, {dup[0]}) * {dup[2]}) filter (metric = 'd') as hi_d,
             max(t.q50 + greatest(t.q50 - t.q25, {chars[0]}) * {chars[2]}) filter (metric = 'c') as hi_c,
             max(t.q50 - greatest(t.q75 - t.q50, {chars[0]}) * {chars[1]}) filter (metric = 'c') as lo_c
      from pick group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(sym <= hi_s, true) and coalesce(dup <= hi_d, true) and coalesce(chars <= hi_c, true) and coalesce(chars >= lo_c, true) as kept
from r left join f on r.lang is not distinct from f.lang and r.source is not distinct from f.source
"""


@register("op8_quality", _quality_sql())
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})


@register("op9_chat", r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(role) + length(text) + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
             + len(regexp_extract_all(role || chr(10) || text, '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
             + 12 + 10 + 10 + 1 as shown from c)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(shown)::bigint as formatted_chars
from e group by conv_id
""")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
                                    "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    made = chat.format_trees(chat.turns_as_chain(rows, "conv_id", "turn", "role", "text"))

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    def read_back(formatted: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, ranges in zip(formatted, spans):
            turns = chat.parse_turns(text)
            learnt = "".join(chat.unescape(text[s["start"]:s["end"]]) for s in ranges)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])

    return made.select(F.col("c").alias("conv_id"), read_back("formatted", "loss_spans").alias("b"),
                       F.length("formatted").cast("long").alias("formatted_chars")).select("conv_id", "b.*", "formatted_chars")


@register("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", F.col("size"), F.crc32(text_of(dealt, "text").cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                        "shard", F.col("slot"), F.lit(None).cast("int").alias("grown_shard"))


@register("op11_substring", r"""
with d as (select row_number() over () as rid, coalesce(doc_id, 9223372036854775807) as id, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
s as (select rid, id, words, unnest(range(1, len(words) - 48)) as pos from d),
w as (select rid, id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) as win from s),
l as (select win, min(id) as least from w group by win),
g as (select rid, pos from w join l using (win) where least < id),
c as (select distinct rid, unnest(range(pos, pos + 50)) as pos from g),
e as (select rid, unnest(words) as word, generate_subscripts(words, 1) as pos from d),
k as (select e.rid, count(*) filter (c.pos is not null)::bigint as n_removed,
             coalesce(string_agg(word, ' ' order by e.pos) filter (c.pos is null), '') as kept
      from e left join c on e.rid = c.rid and e.pos = c.pos group by e.rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (rid)
""")
def op11_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register("op13_phrases", r"""
with p as (select row_number() over () as rid, coalesce(lang, 'und') as lang,
                  string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
           from documents),
q as (select rid, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as i from p),
w as (select rid, i, lang, unnest(ws) as w1, generate_subscripts(ws, 1) as pos from (select rid, i, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from q)),
g as (select lang, w1, lead(w1, 1) over o as w2, lead(w1, 2) over o as w3, lead(w1, 3) over o as w4 from w window o as (partition by rid, i order by pos)),
n as (select lang, count(*)::bigint as n from g group by lang),
f as (select lang, 1 as m, [w1] as ws, count(*) as f from g group by lang, w1
      union all select lang, 2, [w1, w2], count(*) from g where w2 is not null group by lang, w1, w2
      union all select lang, 3, [w1, w2, w3], count(*) from g where w3 is not null group by lang, w1, w2, w3
      union all select lang, 4, [w1, w2, w3, w4], count(*) from g where w4 is not null group by lang, w1, w2, w3, w4),
c as (select * from f where f >= 30),
k as (select c.lang, c.m, c.ws, c.f as a, unnest(range(1, c.m)) as cut from c where c.m > 1),
s as (select k.lang, k.m, k.ws, a, cut, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
      from k join c x on k.lang = x.lang and x.ws = k.ws[1:k.cut] join c y on k.lang = y.lang and y.ws = k.ws[k.cut + 1:k.m]),
b as (select lang, m, ws, a, arg_min(struct_pack(l := l, r := r, score := score), score * 10 + cut) as t from s group by lang, m, ws, a),
inner_parts as (select lang, f, unnest([ws[1:m - 1], ws[2:m]]) as ws from c where m > 2
                union all select lang, f, unnest([ws[1:2], ws[2:3], ws[3:4]]) from c where m = 4),
gone as (select distinct b.lang, b.ws from b join inner_parts i on b.lang = i.lang and b.ws = i.ws where 100 * i.f >= 80 * b.a),
kept as (select b.lang, array_to_string(b.ws, ' ') as phrase, a, t.l as l, t.r as r, t.score as score
         from b left join gone on b.lang = gone.lang and b.ws = gone.ws where gone.lang is null),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score from ranked join n using (lang) where rank <= 2000
""")
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _codes_sql() -> str:
    """Rounds spelt out: every part against every entry."""
    sql = """
with k as materialized (
  select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as q from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as materialized (select rid, part, q[part * (len(q) // 4) + 1:(part + 1) * (len(q) // 4)] as v from k, range(4) t(part)),
b0 as materialized (select part, (row_number() over (partition by part order by vec_id, q) - 1)::bigint as entry, v
      from p join (select rid, vec_id, q from k order by vec_id, q limit 256) using (rid))"""
    for i in range(5):
        sql += f""",
a{i} as materialized (select rid, part, min((list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v))::bigint * 256 + entry) as best
      from p join b{i} b using (part) group by rid, part)"""
        if i < 4:
            sql += f""",
u{i} as (select part, best % 256 as entry, pos, floor(sum(x) / count(*)) as x
       from (select rid, part, unnest(v) as x, generate_subscripts(v, 1) as pos from p) join a{i} using (rid, part) group by part, best % 256, pos),
b{i + 1} as materialized (select b.part, b.entry, coalesce(n.v, b.v) as v
      from b{i} b left join (select part, entry, list(x order by pos) as v from u{i} group by part, entry) n on b.part = n.part and b.entry = n.entry)"""
    return sql + """,
e as (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as pos from b4),
h as (select sha256(string_agg(x::bigint::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from e),
c as (select rid, string_agg(lpad(to_hex(best % 256), 2, '0'), '' order by part) as code, sum(best // 256)::bigint as error from a4 group by rid),
r as (select vec_id, label, lower(code) as code, error from c join k using (rid))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from r, h
"""


@register("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vectorcodes.encode(table(spark, sf_dir, "embeddings"), {"vec_id": F.col("vec_id"), "label": F.col("label")})
    hexed = F.lower(F.concat(*[F.lpad(F.hex(F.element_at("codes", p + 1).cast("long")), 2, "0") for p in range(vectorcodes.PARTS)]))
    return vectorcodes.error_by(coded.rows, "label").select("vec_id", hexed.alias("code"), "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))
