"""The queries of this subpackage and the SQL that states their results, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import decontaminate, fingerprint, lang_id, line_dedup, mixing, ngram_join, secrets, token_output, toxicity, url_filter
from loamline.llm.common import new_path, table

#: The vocabulary that op10 writes with, a file of the installed tokenizers.
TOKENIZER = "byte_bpe_50k.json"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_order(mixing.plan(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE]))
    return found.select("doc_id", *[of(r.kind) for r in secrets.BASE], F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = lang_id.judge(pages, lang_id.train(table(spark, sf_dir, "documents")))
    return found.select("page_id", "host", "suffix", "declared", "text_lang", "lang", F.round("probability", 6).alias("probability"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def tokenizer_json() -> str:
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        return f.read()


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_json())
    return token_output.read_digests(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprint": op8_fingerprint,
    "op9_url_filter": op9_url_filter,
    "op10_token_output": op10_token_output,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _op2_sql() -> str:
    """Each rule's matches by the pieces between them, as the operator's own definition; every text is scanned."""
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
        select n, {rank} as rank, '{rule.kind}' as kind,
          list_sum(list_transform(generate_series(1, i), lambda k: length(g[k]))) + coalesce(list_sum(list_transform(generate_series(1, i - 1), lambda k: length(m[k]))), 0) as start,
          length(m[i]) as len, length(v[i]) as measure, {rule.least} as least
        from (select n, g, m, v, unnest(generate_series(1, len(m))) as i
              from (select n, string_split_regex(t, '{pattern}') as g, regexp_extract_all(t, '{pattern}') as m,
                           regexp_extract_all(t, '{pattern}', {rule.group}) as v from d where regexp_matches(t, '{pattern}')))""")
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
    return f"""
    with d as (select doc_id, row_number() over () as n, coalesce(text, '') as t from documents),
    s as (select n, rank, kind, start, kind || ':' || cast(start as bigint) || ':' || cast(start + len as bigint) as w from ({" union all ".join(parts)}) where measure >= least),
    a as (select n, string_agg(w, ',' order by start, rank) as spans, string_agg(w, ',' order by start, rank) filter (kind in ({base})) as base,
            {", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in secrets.BASE)} from s group by n)
    select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secrets.BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join a using (n)"""


_OP5_SQL = rf"""
with i as (select cast(item_id as varchar) as item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as s
        from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as k from i where len(w) > 0)),
d as (select doc_id, row_number() over () as r, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
dw as (select r, k, n, array_to_string(w[k:k + n - 1], ' ') as s
       from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as k from d, (select distinct n from win) where len(w) >= n)),
h as (select r, k, n, item_id from dw join win using (n, s)),
c as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(k, k + n - 1)) as p from h) group by r),
t as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from h group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (r) left join t using (r)"""

_OP6_SQL = rf"""
with recursive w as (select doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+'), []) as w from documents),
s as (select doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(generate_series(1, len(w) - 3), lambda k: array_to_string(w[k:k + 3], ' ')) end)) as s from w),
c as (select min(doc_id) as id, s, len(s) as n from s where len(s) > 0 group by s),
e as (select id, n, unnest(s) as x from c),
p as (select a.id as a, b.id as b from e a join e b on a.x = b.x and a.id < b.id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
      group by a.id, b.id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
bi as (select a, b from p union all select b, a from p),
r as (select id, id as o from c union select r.id, bi.b from r join bi on r.o = bi.a),
m as (select id, min(o) as component from r group by id)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(m.component, s.doc_id) as component_id
from s left join c on c.s = s.s left join m on m.id = c.id"""

_OP7_SQL = r"""
with d as (select doc_id, text, string_split(text, chr(10)) as b from documents),
l as (select doc_id, k as line, b[k + 1] as body, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(b[k + 1]), '[\s\p{Z}]+'), lambda x: x <> ''))) as w
      from (select doc_id, b, unnest(generate_series(0, len(b) - 1)) as k from d where text is not null)),
c as (select *, row_number() over () as c from (select w, len(w) as n, min(struct_pack(i := doc_id, k := line)) as f from l where len(w) > 0 group by w)),
e as (select c, n, unnest(w) as x from c),
m as (select x, count(*) as m from e group by x),
p as (select c, n, x from (select c, n, e.x, row_number() over (partition by c order by m, e.x) as rank from e join m on m.x = e.x) where rank <= n - (80 * n + 99) // 100 + 1),
q as (select distinct a.c as a, b.c as b from p a join p b on a.x = b.x and a.c < b.c and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
v as (select q.a, q.b, x.f as fa, y.f as fb, x.n + y.n as n, len(list_intersect(x.w, y.w)) as i from q join c x on x.c = q.a join c y on y.c = q.b),
g as (select distinct case when fa < fb then b else a end as c from v where 100 * i >= 80 * (n - i)),
s as (select l.doc_id, l.line, l.body, len(l.w) = 0 or (c.f.i = l.doc_id and c.f.k = l.line and c.c not in (select c from g)) as stays from l left join c on c.w = l.w)
select d.doc_id, cast(case when any_value(d.b) is null then 0 else len(any_value(d.b)) end as bigint) as n_lines, count(s.line) filter (not s.stays) as n_removed,
       case when any_value(d.b) is not null then sha256(coalesce(string_agg(s.body, chr(10) order by s.line) filter (s.stays), '')) end as text_sha256
from d left join s on s.doc_id = d.doc_id group by d.doc_id"""

ORACLES: dict[str, str] = {
    "op2_secrets": _op2_sql(),
    "op5_decontaminate": _OP5_SQL,
    "op6_ngram_join": _OP6_SQL,
    "op7_line_dedup": _OP7_SQL,
}
