"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, bwt, bytebpe, embedding, fim, minhash, negatives, packing, rlz, sharding, toxicity, warc, winnow
from .common import shared_path


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file; ``TOKENIZER_DIR`` overrides the installed folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 by first-fit decreasing in random groups."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")).drop("ids")


def op2_warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of the pages, read back from the chunked record table."""
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    chunks = warc.read_archives(spark, path, keep_data=False).filter("last")
    return chunks.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_minhash_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are 0.85 alike or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=85, den=100).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_range_join_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.95 or more."""
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that occur elsewhere."""
    return rlz.repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op6_toxicity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores by compression distance."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of near equal bytes over fixed virtual slots."""
    records, _ = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return records.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                          F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                          "virtual_slot")


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings that an earlier document has."""
    return bwt.repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts by a walk over the trie of words."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), keep=False)


def op10_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of documents, their edited texts and their neighbours."""
    return winnow.compare_with_edited(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector by the threshold algorithm."""
    return negatives.mine(table(spark, sf_dir, "embeddings"),
                          relabel=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their middles moved to the end."""
    return fim.transform(table(spark, sf_dir, "documents"), keep=False)


def op13_byte_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids and decoded bytes by a segment tree of pair ranks."""
    import public_tokenizers

    return bytebpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"),
                                 public_tokenizers.PATTERN, keep=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pack_documents, op2_warc_pages, op3_minhash_documents, op4_range_join_embeddings, op5_repeated_passages,
    op6_toxicity_documents, op7_shard_documents, op8_repeated_strings, op9_encode_documents, op10_fingerprint_documents,
    op11_hard_negatives, op12_fill_in_middle, op13_byte_encode_documents)}

# The others have no SQL that fits: they are tested against brute force, the tokenizers library and
# exact round trips in tests/llm.
ORACLES: dict[str, str] = {"op2_warc_pages": """
with p as (select page_id::bigint as id, coalesce(html, '') as html from pages),
     q as (select id, strlen(html) as n, sha256(html) as digest from p),
     r as (select id, n, digest, min(id) over (partition by digest) as first from q)
select id as page_id, n as payload_bytes, digest as payload_digest,
       case when n >= 100 and id > first then 'revisit' else 'response' end as record_type,
       case when n >= 100 and id > first then first end as refers_to
from r""",
    "op3_minhash_documents": """
with recursive d as (select row_number() over () as r, doc_id::bigint as id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
            lambda x: x <> '') as w from documents),
     s as (select r, list_distinct(case when len(w) < 3 then list_filter([array_to_string(w, ' ')], lambda x: x <> '')
            else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as s from d),
     c as (select s, min(r) as c, len(s) as n from (select r, list_sort(s) as s from s) group by s),
     g as (select c, n, unnest(s) as g from c),
     l as (select x.c as a, y.c as b from g x join g y on x.g = y.g and x.c <> y.c and x.n * 100 >= y.n * 85 and y.n * 100 >= x.n * 85
           group by x.c, y.c, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
     t as (select c as a, c as b from c union select t.a, l.b from t join l on t.b = l.a),
     m as (select s.r, c.c, c.n from s join c on list_sort(s.s) = c.s),
     k as (select m.c, min(d.id) as id from m join d on m.r = d.r group by m.c),
     o as (select t.a as c, min(k.id) as component from t join k on t.b = k.c group by t.a)
select d.id as doc_id, m.n::bigint as n_shingles, case when m.n = 0 then d.id else o.component end as component_id,
       coalesce(d.id = case when m.n = 0 then d.id else o.component end, m.n = 0 or o.component is null) as kept
from d join m on d.r = m.r join o on m.c = o.c""",
    "op4_range_join_embeddings": """
with recursive e as (select row_number() over () as r, vec_id::bigint as id, embedding::double[] as v,
            embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0 as fine from embeddings),
     l as (select a.r as a, b.r as b from e a join e b on a.r <> b.r and a.fine and b.fine and len(a.v) = len(b.v)
           where list_cosine_similarity(a.v, b.v) >= 0.95),
     t as (select r as a, r as b from e union select t.a, l.b from t join l on t.b = l.a),
     n as (select a, count(*) as n from l group by a),
     o as (select t.a as r, min(e.id) as component from t join e on t.b = e.r group by t.a)
select e.id as vec_id, coalesce(n.n, 0)::bigint as n_links, o.component as component_id, coalesce(e.id = o.component, true) as kept
from e join o on e.r = o.r left join n on e.r = n.a""",
    "op5_repeated_passages": """
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
     r as (select row_number() over () as r, doc_id, w, len(w) as n from d),
     s as (select r, unnest(range(1, n - 33)) as i, w from r where n >= 35),
     g as (select r, i, md5(array_to_string(w[i:i + 34], ' ')) as h from s),
     m as (select r, i from (select r, i, count(*) over (partition by h) as k from g) where k > 1),
     c as (select distinct r, i + j as p from m, (select unnest(range(0, 35)) as j)),
     a as (select r, list(p) as gone from c group by r),
     k as (select r.doc_id, r.n, coalesce(len(gone), 0) as n_removed,
                  case when gone is null then w else list_filter(w, lambda x, i: not list_contains(gone, i)) end as kept
           from r left join a on r.r = a.r)
select doc_id::bigint as doc_id, n::bigint as n_words, n_removed::bigint as n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k""",
    "op8_repeated_strings": """
with d as (select row_number() over () as r, doc_id::bigint as id, coalesce(doc_id::bigint, 9223372036854775807) as age,
                  hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint as n from documents),
     c as (select r, age, n, b, substring(h, 2 * b + 1, 2098) as x from (select *, unnest(range(0, n, 1000)) as b from d)),
     w as (select r, age, b + i as s, md5(substring(x, 2 * i + 1, 100)) as g
           from (select r, age, b, x, unnest(range(0, least(1000, n - b - 49))) as i from c)),
     f as (select w.r, w.s from w join (select g, min(age) as m from w group by g having min(age) < max(age)) o on w.g = o.g where m < age),
     i as (select r, s, sum(fresh) over (partition by r order by s) as k
           from (select r, s, coalesce((s > lag(s) over (partition by r order by s) + 50)::int, 1) as fresh from f)),
     z as (select *, coalesce(lag(e) over (partition by r order by k), 0) as q
           from (select r, k, min(s) as s, max(s) + 50 as e from i group by r, k)),
     y as (select z.r, count(*) as spans, sum(z.e - z.s) as removed, max(z.e) as last,
                  string_agg(substring(d.h, 2 * z.q + 1, 2 * (z.s - z.q)), '' order by z.k) as kept from z join d on z.r = d.r group by z.r)
select d.id as doc_id, d.n as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
       sha256(unhex(case when y.r is null then h else kept || substring(h, 2 * last + 1) end)) as kept_sha256
from d left join y on d.r = y.r""",
    "op11_hard_negatives": """
with e as (select row_number() over () as r, vec_id::bigint as id,
                  case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
     s as (select a.r as a, a.id as anchor_id, b.id, a.label = b.label as same,
                  case when len(a.v) = 0 then 0 else list_inner_product(a.v, b.v) end::bigint as score
           from e a join e b on a.r <> b.r and len(a.v) = len(b.v) where a.id % 100 = 0),
     p as (select a, id, score, row_number() over (partition by a order by score desc, id) as k
           from s where same qualify k <= 5),
     h as (select s.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
                  row_number() over (partition by p.a, p.k order by s.score desc, s.id) as rank
           from p join s on s.a = p.a and not s.same
           where 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from h where rank <= 10""",
    "op12_fill_in_middle": """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
     u as (select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as x,
                  ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
                  ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
     c as (select *, len(x)::bigint as n, least(h1 % (len(x) + 1), h2 % (len(x) + 1)) as a,
                  greatest(h1 % (len(x) + 1), h2 % (len(x) + 1)) as b,
                  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                       when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
     k as (select *, array_to_string(x[1:a], '') as p, array_to_string(x[a + 1:b], '') as m, array_to_string(x[b + 1:], '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                   else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from k"""}
