"""The registered queries of the text operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyherald.llm import decontaminate as dc
from skyherald.llm import divergence as dv
from skyherald.llm import language as lg
from skyherald.llm import licenses as lc
from skyherald.llm import packing as pk
from skyherald.llm import pii as pi
from skyherald.llm import prefix_trie as pt
from skyherald.llm import quality as ql
from skyherald.llm import repeats as rp
from skyherald.llm import secrets as sc
from skyherald.llm import simhash as sh
from skyherald.llm import token_counts as tk
from skyherald.llm import warc as wc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
    with d as (select row_number() over () as r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    x as (select r, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n from d),
    s as (select *, case when i + 34 <= n then string_agg(word, ' ') over
        (partition by r order by i rows between current row and 34 following) end as seq from x),
    c as (select r, i, word, seq is not null and count(*) over (partition by seq) > 1 as starts from s),
    k as (select r, i, word, coalesce(bool_or(starts) over
        (partition by r order by i rows between 34 preceding and current row), false) as gone from c),
    t as (select r, count(*) as n_words, count(*) filter (where gone) as n_removed,
        string_agg(word, ' ' order by i) filter (where not gone) as kept from k group by r)
    select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
      sha256(coalesce(kept, '')) as kept_sha256
    from d left join t using (r)""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = rp.remove_repeats(table(spark, sf_dir, "documents"), min_words=35, with_text=False, carry=["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.packed(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sh.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3, carry=["doc_id"])


def _license_sql() -> str:
    """The same comparison in SQL, without the size bounds and the required bigrams."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(lc.TEMPLATES))
    clean = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9\\n]+', ' ', 'g'), '[ \\n]+', ' ', 'g'))"
    pairs = (
        "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    )
    return f"""
    with t as (select i, name, string_split({clean.format('txt')}, ' ') w from (values {values}) v(i, name, txt)),
    tb as (select i, name, {pairs} b from t),
    l as (select doc_id, lower(coalesce(text, '')) l from documents),
    n as (
      select doc_id, regexp_replace(l, '[^a-z0-9\n]+', ' ', 'g') t, regexp_replace(
        regexp_replace(translate(l, '|', ' '), {quoted(lc.SENTENCE_END)}, '|\\1', 'g'), '[^a-z0-9\n|]+', ' ', 'g') q from l
    ),
    s as (select doc_id, string_split(unnest(regexp_split_to_array(q, '\n *\n')), '|') s from n),
    i as (select doc_id, s, unnest(range(1, len(s) + 1)) i from s),
    u as (
      select doc_id, unnest(string_split(t, chr(10))) u from n
      union all
      select doc_id, u from (select doc_id, unnest(regexp_split_to_array(t, '\n *\n')) u from n)
      where contains(trim(u), chr(10))
      union all
      select doc_id, array_to_string(s[i:i + k - 1], ' ') from i, range(1, {lc.RUN + 1}) r(k) where i + k - 1 <= len(s)
    ),
    w as (select distinct doc_id, string_split(trim(regexp_replace(u, '[ \n]+', ' ', 'g')), ' ') w from u),
    ub as (select row_number() over () unit, doc_id, {pairs} b from w where len(w) >= 2),
    m as (
      select unit, doc_id, name, 2.0::double * len(list_intersect(ub.b, tb.b)) / (len(ub.b) + len(tb.b)) dice
      from ub join tb on list_has_any(ub.b, tb.b)
    ),
    best as (
      select doc_id, name, max(dice) dice from (select * from m where dice >= {lc.LEAST}
        qualify dice = max(dice) over (partition by unit)) group by all
    )
    select d.doc_id, coalesce(string_agg(name, ',' order by name), '') licenses, count(name) n_licenses,
      coalesce(round(max(dice), 6), 0.0) best_dice
    from documents d left join best b on d.doc_id = b.doc_id group by d.doc_id"""


@query(_license_sql())
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lc.license_scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    best = F.coalesce(F.round(F.array_max(F.transform("licenses", lambda m: m["dice"])), 6), F.lit(0.0))
    return found.select(
        "doc_id", F.array_join(F.transform("licenses", lambda m: m["name"]), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"), best.alias("best_dice"),
    )


@query("""
    with p as (
      select page_id, sha1(coalesce(html, '')) d, octet_length(encode(coalesce(html, ''))) n from pages
    ), g as (select *, max(page_id) over (partition by d, n) m from p)
    select page_id, n payload_bytes, d payload_digest,
      case when n >= 1000 and page_id <> m then 'revisit' else 'response' end record_type,
      case when n >= 1000 and page_id <> m then m end refers_to
    from g""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    read = wc.archived(pages, with_payload=False)
    id_type = pages.schema["page_id"].dataType
    return read.select(
        F.col("record_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.quality(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pi.find_pii(table(spark, sf_dir, "documents"), carry=["doc_id"])
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in pi.BASE],
        F.sha2(sc.digest_text(F.col("base")), 256).alias("base_sha256"), sc.digest_text(F.col("spans")).alias("spans"),
    )


@query()
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sc.secret_scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("secrets", lambda s: s["base"])
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(sc.digest_text(base), 256).alias("base_sha256"), sc.digest_text(F.col("secrets")).alias("spans"),
    )


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lg.held_out(F.col("doc_id"))
    model = lg.learn(docs.filter(~out))
    found = lg.identify(docs, model, carry=["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", F.size("lang_spans").alias("n_spans"))


@query()
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dc.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    return found.select(
        "doc_id", "contaminated", F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
        F.transform("matches", lambda m: m["distance"]).alias("distances"),
    )


@query(r"""
    with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as w from documents),
    o as (select r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
    k as (select lang, term, count(*) as in_lang from o group by all having count(distinct r) >= 10),
    l as (select lang, count(*) as v, sum(in_lang)::hugeint as lang_n from k group by lang),
    c as (select lang, source, term, count(*) as n from o join k using (lang, term) group by all),
    g as (select *, coalesce(v, 0) as kinds from
        (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents)
        left join (select lang, source, sum(n)::hugeint as total from c group by all) using (lang, source)
        left join l using (lang)),
    p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.in_lang, g.v, g.lang_n,
        1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (coalesce(g.total, 0) + 2 * g.v) as p
        from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
    pairs as (select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
        from g a join g b on a.lang = b.lang and a.source <> b.source left join (
          select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
          from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ) x on x.lang = a.lang and x.source = a.source and x.item = b.source),
    q as (select *, 1 + 1000000000::hugeint * (in_lang + 2) // (lang_n + 2 * v) as q from p where n > 0),
    terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from q where p > q),
    x as (select lang, source, 'pair' as part, item, value from pairs union all
      select lang, source, 'term', item, value from terms)
    select lang, source, part, item, value::bigint as value, rank::int as rank from (
      select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from x)
    where part = 'pair' or rank <= 10""")
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dv.source_divergence(table(spark, sf_dir, "documents"))


# crc32 of a number's decimal digits: for each byte eight steps of the reversed polynomial
_CRC = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""


@query(rf"""
    with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id
        order by turn nulls first, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
        from conversations where conv_id is not null),
    h as (select c, {_CRC} % 9 as h from (select distinct c from t)),
    r as (select h.c, t.i, role, text from h join t on t.c = h.c - h.c % 5 and t.i <= h
      union all select h.c, i, role, text from h join t on t.c = h.c and t.i > h),
    o as (select c, row_number() over (partition by c order by i) as d, role, text from r),
    k as (select c, d, strlen(text) as b, md5(string_agg(md5(role) || md5(text), '' order by d) over (partition by c order by d)) as k
      from o),
    m as (select c, d, b, k from k union all select c, 0, 0, '' from h),
    l as (select c, max(d) as n from m group by c),
    nodes as (select k, d, any_value(b) as b, min(c) as id, count(*) as n,
        coalesce(string_agg(c::varchar, ',' order by c) filter (where d = l.n), '') as ends
        from m join l using (c) group by k, d),
    up as (select a.k, a.d, p.k as pk, p.id as pid from nodes a join m on m.c = a.id and m.d = a.d - 1 join nodes p on p.k = m.k and p.d = m.d),
    kids as (select pk, count(*) as n from up group by pk),
    s as (select anc.k, sum((a.n - 1) * a.b) as saved, count(*) filter (where kids.n is null) as leaves
        from nodes a left join kids on kids.pk = a.k join m anc on anc.c = a.id and anc.d <= a.d group by anc.k)
    select a.id as conv_id, a.d as depth, up.pid as parent_conv_id, a.n as n_convs, coalesce(kids.n, 0) as n_children,
      s.leaves as n_leaves, s.saved::bigint as saved_tokens, sha256(a.ends) as ends_sha256
    from nodes a left join up on up.k = a.k and up.d = a.d left join kids on kids.pk = a.k join s on s.k = a.k""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.prefix_trie(table(spark, sf_dir, "conversations"))


def vocabulary_path() -> str:
    """The vocabulary file of the registered query, beside the library that brings the files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path(), carry=["doc_id"])
