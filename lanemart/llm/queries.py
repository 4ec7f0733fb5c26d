"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanemart.llm import chat, decontaminate, exact_dedup, line_dedup, lm, mixing, multi_index, periodic, quality, secrets, simhash, spelling, toxicity
from lanemart.llm.common import remainder, table
from lanemart.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("""
with t as (
  select doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as h
  from documents
), w as (
  select *, row_number() over (partition by h order by n desc, doc_id) as r, count(*) over (partition by h) as c,
         first_value(doc_id) over (partition by h order by n desc, doc_id) as k
  from t
)
select doc_id, k as keep_id, c as group_size, r = 1 as kept, h as text_sha256 from w
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


_CHAT_TURNS = """
select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
"""


@query(f"""
with t as ({_CHAT_TURNS}), e as (
  select *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') as escaped from t
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>' || role || chr(10) || escaped || '<|im_end|>' || chr(10)))::bigint as formatted_chars
from e group by conv_id
""")
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    probe = [F.struct(F.lit(-1).alias("conv_id"), F.lit(n).alias("turn"), F.lit(r).alias("role"), said.alias("text")) for n, r in enumerate(("user", "assistant"))]
    return chat.round_trip(rows.union(spark.range(1).select(F.inline(F.array(*probe)))))


def _span_sql() -> str:
    """Matches of every rule with their offsets, from the pieces between them."""
    parts = []
    for rank, r in enumerate((*secrets.BASE, *secrets.MORE)):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
        select doc_id, {rank} as rank, '{r.kind}' as kind, {r.least} as least,
               regexp_extract_all(t, '{pattern}') as hits, regexp_extract_all(t, '{pattern}', {r.group}) as sizes,
               string_split_regex(t, '{pattern}') as gaps from d""")
    return " union all ".join(parts)


@query(f"""
with d as (select doc_id, coalesce(text, '') as t from documents), m as ({_span_sql()}), s as (
  select doc_id, rank, kind, least, unnest(hits) as hit, unnest(sizes) as part, unnest(gaps[1:len(hits)]) as gap,
         generate_subscripts(hits, 1) as n from m where len(hits) > 0
), o as (
  select *, sum(length(gap) + length(hit)) over (partition by doc_id, rank order by n) as stop from s
), k as (
  select *, kind || ':' || (stop - length(hit))::bigint || ':' || stop::bigint as said, stop - length(hit) as start
  from o where length(part) >= least
)
select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
       count(*) filter (kind = 'hex') as n_hex,
       sha256(coalesce(string_agg(said, ',' order by start, rank) filter (rank < 3), '')) as base_sha256,
       coalesce(string_agg(said, ',' order by start, rank), '') as spans
from d left join k on d.doc_id = k.doc_id group by d.doc_id
""")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _judged(scored: DataFrame, divisor: int, held: int) -> DataFrame:
    return scored.select(
        "doc_id", (remainder("doc_id", divisor) == held).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return _judged(quality.score(docs, model), 3, 1)


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return _judged(toxicity.score(docs, model).drop("text"), 5, 0)


def _lines_sql() -> str:
    text = f"regexp_replace(coalesce(html, ''), '{line_dedup.UNSEEN}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{line_dedup.BREAKS}', chr(10), 'g'), '{line_dedup.TAGS}', '', 'g')"
    for entity, char in line_dedup.ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, entity, char.replace("'", "''"))
    text = f"regexp_replace({text}, '{line_dedup.SPACES}', ' ', 'g')"
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


@query(f"""
with l as (
  select page_id, lower(coalesce(regexp_extract(url, '{line_dedup.HOST}', 1), '')) as host, {_lines_sql()} as lines,
         row_number() over () as n from pages
), t as (select host, count(*) as total from l group by host),
h as (select host, line, count(*) as pages from (select distinct n, host, unnest(lines) as line from l) group by host, line),
b as (select h.host, line from h join t using (host) where pages >= 3 and pages > 0.3 * total),
e as (select n, host, unnest(lines) as line, generate_subscripts(lines, 1) as k from l where len(lines) > 0),
k as (
  select e.n, count(*) filter (b.line is not null) as dropped,
         coalesce(string_agg(e.line, chr(10) order by k) filter (b.line is null), '') as text
  from e left join b on e.host = b.host and e.line = b.line group by e.n
)
select page_id, host, len(lines)::bigint as n_lines, coalesce(dropped, 0)::bigint as n_dropped, coalesce(text, '') as text
from l left join k using (n)
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


@query("""
with recursive sizes as (
  select coalesce(source, '') as s, pow(count(*), 0.7) as w from documents group by 1
), exact as (
  select s, (1000 - count(*) over ()) * (w / sum(w) over ()) as x, count(*) over () as n from sizes
), rounded as (
  select s, floor(x) as f, row_number() over (order by floor(x) - x, s) as r, 1000 - n - sum(floor(x)) over () as late from exact
), shares as (select s, (1 + f + case when r <= late then 1 else 0 end)::bigint as share, row_number() over (order by s) as i from rounded),
lists as (select list(share order by s) as a from shares),
picks(t, done, pick) as (
  select -1::bigint, (select list_transform(a, lambda x: 0::bigint) from lists), 0::bigint
  union all
  select t + 1, list_transform(done, lambda d, i: case when i = p then d + 1 else d end), p
  from (
    select t, done, list_position(due, list_min(due))::bigint as p
    from (
      select t, done, list_transform(a, lambda x, i: case when done[i] < x and done[i] * 1000 // x <= t + 1
             then ((done[i] + 1) * 1000 + x - 1) // x else 1000000 end) as due
      from picks, lists where t < 999
    )
  )
), plan as (select pick as i, done[pick] - 1 as k, t from picks where pick > 0),
ranked as (
  select doc_id, coalesce(source, '') as s,
         row_number() over (partition by coalesce(source, '') order by md5(coalesce(doc_id::varchar, '')), doc_id) - 1 as r
  from documents
)
select doc_id, r.s as source, share::integer as share, r // 16 as block, (r // 16) // share * 1000 + plan.t as slot, r % 16 as "offset"
from ranked r join shares using (s) join plan on plan.i = shares.i and plan.k = (r // 16) % share
""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return mixing.mix(docs)


@query()
def op1_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = remainder("doc_id", 7) == 2
    scored = lm.score(table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("""
with recursive v as (
  select row_number() over (order by vec_id) as k, vec_id, label, embedding::double[] as e from embeddings
), fine as (
  select * from v where vec_id is not null and label is not null and len(list_filter(e, lambda x: x <> 0)) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
), links as (
  select a.k as a, b.k as b from fine a join fine b on a.label = b.label and a.k <> b.k and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93
), reach(k, r) as (select k, k from v union select reach.k, b from reach join links on r = a),
least as (select reach.k, min(vec_id) as component_id from reach join v on v.k = r group by reach.k)
select vec_id, (select count(*) from links where a = v.k) as n_links, component_id, vec_id is not distinct from component_id as kept
from v join least using (k)
""")
def op11_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def _drop_a_letter(doc_id: Column, run: Column) -> Column:
    """The run without one of its code points where its checksum says so."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run))
    k = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(run.substr(F.lit(1), k), run.substr(k + 2, F.length(run)))).otherwise(run)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query(f"""
with recursive codes as (
  select list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by k) as code
  from range(256) as t(k)
), runs as (
  select doc_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '{spelling.LETTERS}{{7,}}'),
                                       lambda x: translate(x, '{_UPPER}', '{_UPPER.lower()}'))) as run
  from documents
), counted as (
  select run, count(*) as c, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from runs group by doc_id, run
), summed as (
  select run, c, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(length(x) // 2), lambda i: ('0x' || substring(x, 2 * i + 1, 2))::bigint),
    lambda h, b: xor(h // 256, code[xor(h, b) % 256 + 1]))) as h
  from counted, codes
), words as (
  select w as word, sum(c)::bigint as n
  from (select c, case when h % 31 = 0 then left(run, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as w from summed)
  where length(w) >= 7 group by w having sum(c) >= 2
), cuts as (
  select word, n, i, left(word, i::int - 1) || substring(word, i::int + 1) as d from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), pairs as (
  select a.word as a, b.word as b from cuts a join cuts b on a.i = b.i and a.d = b.d and a.word <> b.word
  union select a.word, b.word from cuts a join words b on a.d = b.word
  union select b.word, a.word from cuts a join words b on a.d = b.word
), best as (
  select p.a as word, count(*) as n_near, first(p.b order by w.n desc, p.b) as b, max(w.n) as m from pairs p join words w on w.word = p.b group by p.a
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * w.n then b end as form, case when m >= 10 * w.n then m end as form_n
  from words w left join best using (word)
), walk as (
  select word, word as at from formed
  union all select walk.word, f.form from walk join formed f on walk.at = f.word and f.form is not null
)
select f.word, f.n, f.n_near, f.form, f.form_n, w.at as root
from formed f join walk w on f.word = w.word join formed g on w.at = g.word and g.form is null
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), least=7, edit=_drop_a_letter)
    return spelling.variant_groups(words.filter("n >= 2"), times=10)


def repeat_from(doc_id, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts repeat, from some word on, a stretch of themselves to the end."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeat_from)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    denser = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    best = F.reduce("runs", F.get("runs", F.lit(0)), denser)  # runs come by start, then period: the first of ties stays
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), best.alias("best"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
