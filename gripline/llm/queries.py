"""Named queries of this subpackage and, where SQL can say the same over whole tables, the SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripline.llm import decontaminate, hilbert, infill, lines, minhash, mixing, negatives, packing, quality, tokens, toxicity, vectors, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Systematic sampling of all documents to source weights."""
    docs = table(spark, folder, "documents")
    sized = docs.select("doc_id", "source", mixing.words(docs["text"]).alias("n_words"))
    mixed = mixing.mix(sized, size=sized["n_words"])
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links of cosine 0.98 or more within labels, and one kept vector per component."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item or an edited copy of one: a row per pair, with the aligned passage."""
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all whole texts."""
    return quality.query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of each document."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards along the curve."""
    docs = table(spark, folder, "documents")
    rows = hilbert.shard(docs.select("doc_id", "lang", "source", "text"), keep=("doc_id",))
    return rows.select(*hilbert.digest(rows))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all whole texts."""
    return toxicity.query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as token ids, read back from the files."""
    return tokens.round_trip(table(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All texts without the lines that earlier documents hold."""
    rows = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    return warc.round_trip(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every positive of every anchor, against all vectors."""
    rows = table(spark, folder, "embeddings")
    return negatives.hard_negatives(rows, label=negatives.shifted_label(rows))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All texts cut and put together anew, and what their outputs give back."""
    rows = infill.fill_in_middle(table(spark, folder, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    back = infill.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    cut = packing.pieces(table(spark, folder, "documents"))
    return packing.digest(cut, packing.pack(cut))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_mixing, op2_embedding_dedup, op3_decontamination, op4_quality, op5_near_dedup, op6_sharding, op7_toxicity, op8_token_files, op9_line_dedup, op10_warc, op11_hard_negatives, op12_fill_in_middle, op13_packing)
}

#: Hash parts and offsets of the sampling, as in common.spread and mixing.mix.
OP1 = r"""
with d as (
  select doc_id, case when source is null then '1' else '0' || source end as k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 6))::bigint % 32 as block
  from documents),
c as (select *, length(cast(n as varchar)) * 100 + cast(substr(cast(n as varchar), 1, 2) as int) as class from d),
s as (select k, sum(n)::bigint as n_source from c group by k),
w as (select k, n_source, ((row_number() over (order by k) - 1) % 3 + 1)::double as w, n_source::double * 3.0 as cap from s),
o as (select *, sum(n_source) over ()::double as total,
             coalesce(sum(cap) over (order by cap / w, k rows between unbounded preceding and 1 preceding), 0.0) as used,
             sum(w) over (order by cap / w, k rows between current row and unbounded following) as open from w),
f as (select *, (total - used) / open >= cap / w as filled from o),
t as (select k, n_source, case when filled then cap else
        (total - coalesce(sum(case when filled then cap end) over (), 0.0)) / (sum(case when not filled then w end) over ()) * w end as target from f),
p as (select c.doc_id, c.n, t.n_source, t.target, case when t.n_source > 0 then t.target / t.n_source::double else 0.0 end as rate,
             (row_number() over (partition by c.k order by c.class, c.block, c.n, c.doc_id))::double as pos,
             ('0x' || substr(md5('mix' || c.k), 1, 4))::bigint::double / 65536.0 as start
      from c join t on c.k = t.k)
select doc_id, n as size, n_source as source_size, target, n * (floor(pos * rate + start) - floor((pos - 1.0) * rate + start))::bigint as taken from p
"""

OP9 = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
x as (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from d),
k as (select doc_id, i, ls[i] as line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from x),
o as (select key, min(doc_id) as owner from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
j as (select k.*, o.owner is not null and o.owner <> k.doc_id as lost from k left join o on k.key = o.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where lost)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not lost), '')) as kept_sha256
from j group by doc_id
"""

OP10 = """
with p as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
o as (select body, max(page_id) as owner from p where n >= 1000 group by body)
select p.page_id, n::bigint as payload_bytes, sha1(p.body) as payload_digest,
       case when o.owner is not null and o.owner <> p.page_id then 'revisit' else 'response' end as record_type,
       case when o.owner <> p.page_id then o.owner end as refers_to
from p left join o on p.body = o.body
"""

OP2 = """
with v as (select vec_id, label, [x::double for x in embedding] as e from embeddings),
g as (select *, sqrt(list_dot_product(e, e)) as n from v where label is not null and e is not null and len([x for x in e if x is null or not isfinite(x)]) = 0 and len(e) > 0),
l as (select a.vec_id as a, b.vec_id as b from g a join g b on a.label = b.label and a.vec_id <> b.vec_id and a.n > 0 and b.n > 0 and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r as (with recursive r(vec_id, other) as (select vec_id, vec_id from embeddings union select r.vec_id, l.b from r join l on r.other = l.a) select * from r),
m as (select vec_id, min(other) as component_id from r group by vec_id),
c as (select a as vec_id, count(*) as n_links from l group by a)
select m.vec_id, coalesce(c.n_links, 0)::bigint as n_links, m.component_id, m.vec_id = m.component_id as kept from m left join c on m.vec_id = c.vec_id
"""

OP11 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as q from embeddings
           where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as rank
      from p join s using (anchor_id) where not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 10
"""

OP12 = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h from documents),
u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as us, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2, ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
c as (select *, len(us) as n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) as a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) as b,
      case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
x as (select *, array_to_string(us[1:a], '') as p, array_to_string(us[a + 1:b], '') as m, array_to_string(us[b + 1:], '') as s from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars, case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256, sha256(t) as restored_sha256
from x
"""

SQL: dict[str, str] = {"op1_mixing": OP1, "op2_embedding_dedup": OP2, "op9_line_dedup": OP9, "op10_warc": OP10, "op11_hard_negatives": OP11, "op12_fill_in_middle": OP12}
