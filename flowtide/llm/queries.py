"""The registered queries of this subpackage, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.llm import (
    block_lstm,
    hard_negatives,
    hyperlang,
    line_crf,
    merkle_audit,
    norm_topk,
    poisson_mix,
    preferences,
    recompression,
    repair,
    simhash,
    unigram,
    weak_toxicity,
)
from flowtide.llm.storage import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SUBSTRING_SQL = r"""
with d as (
  select row_number() over () id, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') w from documents),
windows as (select id, p, sha256(array_to_string(w[p : p + 34], ' ')) h from (select id, w, unnest(range(1, len(w) - 33)) p from d where len(w) >= 35)),
again as (select id, p from windows where h in (select h from windows group by h having count(*) > 1)),
gone as (select id, list(distinct k) g from (select id, unnest(range(p, p + 35)) k from again) group by id),
marked as (select doc_id, w, g from d left join gone using (id)),
kept as (
  select doc_id, len(w) n, w[:0] || list_transform(list_filter(list_zip(range(1, len(w) + 1), w), lambda x: not list_contains(coalesce(g, []), x[1])), lambda x: x[2]) k
  from marked)
select doc_id, n::bigint n_words, (n - len(k))::bigint n_removed, sha256(array_to_string(k, ' ')) kept_sha256 from kept
"""


@query("op6_substring_dedup", _SUBSTRING_SQL)
def _(spark, folder):
    """Words kept after all windows of 35 words that occur anywhere else are gone."""
    return recompression.removal_report(table(spark, folder, "documents"), window=35)


@query("op9_simhash_groups")
def _(spark, folder):
    """Fingerprint and group of every document."""
    groups = simhash.simhash_groups(table(spark, folder, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


@query("op3_weak_toxicity")
def _(spark, folder):
    """Toxicity score of every document, from labels outside the held-out quarter."""
    docs = table(spark, folder, "documents")
    model = weak_toxicity.train(docs, table(spark, folder, "labels"), ~held_out())
    scored = weak_toxicity.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op7_hyperdimensional_language")
def _(spark, folder):
    """Language of every document, from documents outside the held-out quarter."""
    docs = table(spark, folder, "documents")
    model = hyperlang.train(docs, ~held_out())
    return hyperlang.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op10_line_crf_quality")
def _(spark, folder):
    """Counts, base rules and the verdict of the line labels for every document."""
    docs = table(spark, folder, "documents")
    field = line_crf.train_field(docs, table(spark, folder, "labels"))
    return line_crf.quality_report(docs, field)


_PREFERENCES_SQL = """
with base as (
  select distinct conv_id pair_id, turn, coalesce(role, '') "role", replace(coalesce(text, ''), '<|im_', '< |im_') t
  from conversations where conv_id is not null),
last as (
  select pair_id, max(turn) last from base where "role" = 'assistant' group by 1),
answers as (
  select b.pair_id, l.last, max(t) lent from base b join last l on b.pair_id = l.pair_id and b.turn = l.last
  where "role" = 'assistant' group by 1, 2),
swapped as (
  select distinct b.pair_id, b.turn, b."role",
         case when b."role" = 'assistant' and b.turn = m.last and n.lent is not null then n.lent else b.t end t
  from base b left join answers m on b.pair_id = m.pair_id left join answers n on n.pair_id = xor(b.pair_id, 1)),
sides as (
  select 'c' side, *, row_number() over (partition by pair_id order by turn nulls first, "role", t) pos from base
  union all
  select 'r', *, row_number() over (partition by pair_id order by turn nulls first, "role", t) from swapped),
matched as (
  select pair_id, pos, count(*) = 2 and min("role") = max("role") and min(t) = max(t) same from sides group by 1, 2),
shared as (
  select pair_id, coalesce(min(pos) filter (where not same) - 1, max(pos)) n from matched group by 1),
parts as (
  select side, s.pair_id, pos, n, "role",
         '<|im_start|>' || "role" || chr(10) head, t || '<|im_end|>' || chr(10) body
  from sides s join shared h on s.pair_id = h.pair_id),
placed as (
  select *, coalesce(sum(length(head) + length(body)) over (partition by pair_id, side, pos > n order by pos
            rows between unbounded preceding and 1 preceding), 0) start_at from parts)
select pair_id, any_value(n)::int prompt_turns,
       coalesce(string_agg(head || body, '' order by pos) filter (where side = 'c' and pos <= n), '') prompt,
       coalesce(string_agg(head || body, '' order by pos) filter (where side = 'c' and pos > n), '') chosen,
       coalesce(string_agg(head || body, '' order by pos) filter (where side = 'r' and pos > n), '') rejected,
       coalesce(string_agg((start_at + length(head))::bigint || ':' || (start_at + length(head) + length(body) - 1)::bigint, ','
                order by pos) filter (where side = 'c' and pos > n and "role" = 'assistant'), '') chosen_spans,
       coalesce(string_agg((start_at + length(head))::bigint || ':' || (start_at + length(head) + length(body) - 1)::bigint, ','
                order by pos) filter (where side = 'r' and pos > n and "role" = 'assistant'), '') rejected_spans
from placed group by pair_id
"""


@query("op1_preference_format", _PREFERENCES_SQL)
def _(spark, folder):
    """Every conversation against itself with a neighbour's last answer."""
    pairs = preferences.format_preferences(*preferences.swapped_answers(table(spark, folder, "conversations")))
    spans = {
        c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
        for c in ("chosen_spans", "rejected_spans")
    }
    return pairs.withColumns(spans)


_TOP_K_SQL = """
with v as (
  select distinct vec_id::bigint vec_id, [floor(256 * x::double) for x in embedding] e from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select q.vec_id query_id, c.vec_id, max(list_inner_product(q.e, c.e))::bigint score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0 group by 1, 2),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
"""


@query("op2_norm_topk", _TOP_K_SQL)
def _(spark, folder):
    """The five best inner products of every fiftieth vector."""
    vectors = table(spark, folder, "embeddings")
    return norm_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


_MIX_SQL = """
with counts as (select source, count(*) n from documents group by 1),
rates as (
  select source, n, sqrt(n) * (select sum(n) from counts) / (select sum(sqrt(n)) from counts) / n rate from counts),
parts as (
  select source, rate, greatest(ceil(rate / 32), 1)::int parts, unnest(range(greatest(ceil(rate / 32), 1)::int)) part from rates),
terms as (
  select source, part, rate / parts mean, unnest(range((ceil(rate / parts * 3 + 40))::int + 1)) k, parts from parts),
cdf as (
  select source, part, k,
         sum(exp(k * ln(mean) - mean - lgamma(k + 1))) over (partition by source, part order by k) f from terms),
drawn as (
  select d.*, p.part, ('0x' || substr(md5('mix/' || coalesce(d.doc_id::varchar, '') || '/' || p.part), 1, 13))::bigint
         / 4503599627370496.0 u
  from documents d join parts p on d.source is not distinct from p.source),
kept as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, d.part, count(*) filter (where c.f <= d.u) copies
  from drawn d join cdf c on d.source is not distinct from c.source and d.part = c.part group by all),
copied as (select *, part * 100000 + unnest(range(copies)) copy from kept where copies > 0)
select doc_id, text, lang, source, n_chars, copy::bigint copy,
       ('0x' || substr(md5('mix-order/' || coalesce(doc_id::varchar, '') || '/' || copy), 1, 13))::bigint order_key
from copied
"""


@query("op4_poisson_mix", _MIX_SQL)
def _(spark, folder):
    """All documents, replicated to weights that are the square roots of the sources' sizes, in random order."""
    mixed = poisson_mix.mix(table(spark, folder, "documents"), seed="mix")
    order = (F.col("_order") * float(1 << 52)).cast("bigint")
    return mixed.select("doc_id", "text", "lang", "source", "n_chars", F.col("_copy").alias("copy"), order.alias("order_key"))


@query("op5_unigram_tokens")
def _(spark, folder):
    """Pieces of every document, and whether decoding gives the text back."""
    return unigram.token_report(table(spark, folder, "documents"), unigram.load_model())


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves of all pages as records, and of a replica with damage by rule: flipped characters, lost records, records written twice."""
    broken = F.concat(F.substring("payload", 1, 40), F.lit("?"), F.expr("substring(payload, 42)"))
    both = stored(merkle_audit.warc_leaves(pages, F.when(F.col("page_id") % 101 == 7, broken).otherwise(F.col("payload"))))
    kept = both.where("page_id % 211 <> 3").select("file", "offset", "page_id", F.col("length_changed").alias("length"), F.col("hash_changed").alias("hash"))
    return both, kept.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("page_id") % 307 == 5, 2).otherwise(1)))).drop("_n")


_AUDIT_SQL = """
with p as (select distinct page_id, coalesce(url, '') url, coalesce(html, '') html from pages where page_id is not null),
made as (
  select page_id, floor(page_id / 512)::bigint file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
         || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
         || html || chr(13) || chr(10) || chr(13) || chr(10) payload from p),
a as (
  select *, coalesce(sum(strlen(payload)) over (partition by file order by page_id, sha256(payload)
            rows between unbounded preceding and 1 preceding), 0)::bigint "offset" from made),
b as (
  select file, "offset", case when page_id % 101 = 7 then substr(payload, 1, 40) || '?' || substr(payload, 42) else payload end payload,
         unnest(range(case when page_id % 307 = 5 then 2 else 1 end)) again
  from a where page_id % 211 <> 3),
x as (select file, "offset", strlen(payload)::bigint n, sha256(payload) h, count(*) c from a group by all),
y as (select file, "offset", strlen(payload)::bigint n, sha256(payload) h, count(*) c from b group by all)
select coalesce(x.file, y.file) file, coalesce(x."offset", y."offset") "offset", x.n length_left, y.n length_right,
       x.h hash_left, y.h hash_right,
       case when y.h is null then 'missing' when x.h is null then 'extra' when x.h <> y.h then 'changed' else 'repeated' end kind
from x full join y on x.file = y.file and x."offset" = y."offset"
where x.h is distinct from y.h or x.c <> y.c
"""


@query("op8_merkle_audit", _AUDIT_SQL)
def _(spark, folder):
    """Damage of a replica of all pages, written as WARC records, found from the roots down."""
    return merkle_audit.audit_leaves(*replicas(table(spark, folder, "pages")))


def _repair_sql() -> str:
    """A forward pass over each conversation's turns: four states, each nine digits of cost and the audit behind them."""

    def more(x: str, cost: str, letter: str) -> str:
        return f"(lpad((left({x}, 9)::int + {cost})::varchar, 9, '0') || substr({x}, 10) || '{letter}')"

    never = "'999999999'"
    x0, xs, xu, xa = (f"x[{i}]" for i in range(1, 5))
    role, live, extra = "left(y[1], 1)", "y[1] <> 'x'", "(case when y[1] = upper(y[1]) then 3 else 0 end)"
    to_user = f"least({x0}, {xs}, {xa})"

    def when(test: str, value: str) -> str:
        return f"(case when {test} then {value} else {never} end)"

    turns = (
        more(x0, "4", "D"),
        f"least({more(xs, '4', 'D')}, {when(f'lower({role}) = $$s$$', more(x0, extra, 'K'))})",
        f"least({more(xu, '4', 'D')}, {when(f'lower({role}) = $$u$$', more(to_user, extra, 'K'))}, {when(live, more(to_user, '3 + ' + extra, 'R'))})",
        f"least({more(xa, '4', 'D')}, {when(f'lower({role}) = $$a$$', more(xu, extra, 'K'))}, {when(live, more(xu, '3 + ' + extra, 'R'))})",
    )
    inserted = (
        x0, xs, f"least({xu}, {more(f'least({x0}, {xs}, {xa})', '3', 'I')})",
        f"least({xa}, {more(xu, '3', 'I')}, {more(more(f'least({x0}, {xs})', '3', 'I'), '3', 'I')})",
    )
    start = "['000000000', '999999999', '000000003I', '000000006II']"
    return f"""
with damage as (
  select conv_id, turn, coalesce("role", ' ') "role", coalesce(text, ' ') text,
         xor(list_reduce(flatten(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
             lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end, 4294967295::bigint), 4294967295) % 20 rule
  from conversations),
rows as (
  select conv_id, turn, case when rule = 4 then 'user' else "role" end "role",
         case rule when 1 then '' when 2 then translate(text, '.!?', '') else text end text,
         unnest(range(case when rule = 3 then 2 else 1 end)) copy from damage where rule <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, "role", text, copy) rn,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) bare from rows),
faults as (
  select *, left("role", 1) ini, case when bare = '' then 'blank'
         when row_number() over (partition by conv_id, "role", text order by rn) > 1 then 'duplicate'
         when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end fault,
         lag(left("role", 1)) over (partition by conv_id order by rn) prev from placed),
signs as (
  select *, case when fault in ('blank', 'duplicate') then 'x'
                 when fault = 'truncated' then upper(case when ini in ('s', 'u', 'a') then ini else 'o' end)
                 when ini in ('s', 'u', 'a') then ini else 'o' end sign from faults),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank,
         count(*) filter (where fault = 'duplicate') duplicate, count(*) filter (where fault = 'truncated') truncated,
         count(*) filter (where prev is not null and prev || ini not in ('su', 'ua', 'au')) illegal,
         list_reduce(flatten(list([[sign], ['']] order by rn)), lambda x, y: case when y[1] = ''
             then [{', '.join(inserted)}] else [{', '.join(turns)}] end, {start}) ends
  from signs group by conv_id),
solved as (select *, least(ends[1], ends[4]) won from counted),
letters as (
  select conv_id, p, substr(won, 9 + p, 1) letter
  from (select conv_id, won, unnest(range(1, length(won) - 8)) p from solved)),
steps as (
  select *, sum((letter <> 'I')::int) over w rn, sum((letter <> 'D')::int) over w out from letters
  window w as (partition by conv_id order by p)),
made as (
  select s.conv_id, p, out, letter, f."role", f.text, max((out = 1 and letter = 'K' and ini = 's')::int) over (partition by s.conv_id) lead
  from steps s left join faults f on s.conv_id is not distinct from f.conv_id and s.rn = f.rn and letter <> 'I' where letter <> 'D'),
texts as (
  select conv_id, sha256(string_agg(
           (case when letter = 'K' then "role" when (out - lead) % 2 = 1 then 'user' else 'assistant' end) || ':' ||
           (case when letter = 'I' then '' else text end), chr(10) order by p)) h from made group by conv_id)
select i.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate,
       coalesce(truncated, 0)::bigint truncated, coalesce(illegal, 0)::bigint illegal, coalesce(left(won, 9)::bigint, 0) cost,
       coalesce(substr(won, 10), '') audit, coalesce(h, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) i
left join solved s on i.conv_id is not distinct from s.conv_id left join texts t on i.conv_id is not distinct from t.conv_id
"""


@query("op12_repair_conversations", _repair_sql())
def _(spark, folder):
    """Faults, cheapest edits and repaired text of every conversation after damage by rule."""
    conversations = table(spark, folder, "conversations")
    return repair.repair_report(repair.damaged(conversations), conversations)


_HARD_NEGATIVES_SQL = """
with v as (
  select distinct vec_id::bigint vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
         [floor(256 * x::double) for x in embedding] e
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select q.vec_id anchor_id, q.e anchor, q.label = c.label same, c.vec_id, list_inner_product(q.e, c.e)::bigint score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id positive_id, row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::int "rank",
       s.vec_id negative_id, p.score positive_score, s.score negative_score
from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score
qualify "rank" <= 5
"""


@query("op13_hard_negatives", _HARD_NEGATIVES_SQL)
def _(spark, folder):
    """The five hardest negatives for each of the five best positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op11_recurrent_extraction")
def _(spark, folder):
    """The article of every page, as the recurrent labeller sees it."""
    pages = table(spark, folder, "pages")
    return block_lstm.extract(pages, block_lstm.train(pages))
