"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import (centroids, crosspolytope, crosstok, factors, lm, mixing, neardup, packing, quality, tokenfiles,
                            toxicity, warc, wrappers)
from strandline.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of folds 0, 1 and 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learnt = labels.where(crc_mod(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, learnt))
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("sentences").alias("n_toxic_sentences"),
        F.array_max(F.transform("sentences", lambda s: F.struct(s["p"], -s["start"], s["end"])))["end"]
        .alias("worst_sentence_end"))


OP6_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
m as (select *, len(w)::bigint as n_words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]) as win from t),
p as (select doc_id, g, unnest(pos) as i from (
        select doc_id, g, list(i) as pos from (select doc_id, unnest(win) as g, generate_subscripts(win, 1) as i from m)
        group by doc_id, g having count(*) > 1)),
r as (select doc_id, count(distinct i + k)::bigint as n from p, (select unnest([0, 1, 2]) as k) group by doc_id),
b as (select m.doc_id, n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) as up, length(regexp_replace(text, '[^a-z]', '', 'g')) as low,
        length(regexp_replace(text, '[^!-/0-9:-@\[-`{-~]', '', 'g')) as other
      from m left join r using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 20 * n_words or 100 * n_dup_lines > 50 * n_lines
            or 100 * up > 60 * (up + low) or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 100 * other > 40 * word_chars) as kept
from f"""


@query("op6_quality_rules", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the cascade's verdict for every document."""
    return quality.quality_report(table(spark, sf_dir, "documents")).drop("rejected_by")


@query("op2_minhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), special=True)


OP9_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
                  md5('mix-1:' || coalesce(doc_id::varchar, '')) as h from documents),
s as (select source, sum(size)::bigint as source_size,
             case (row_number() over (order by source nulls last) - 1) % 3
               when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w
      from d group by source),
o as (select *, 2.0::double * source_size as cap,
             row_number() over (order by 2.0::double * source_size / w, source nulls last) as k from s),
c as (select *, coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)::double as cut,
             (sum(w) over (order by k rows between current row and unbounded following))::double as rest,
             (select 1.5::double * sum(source_size) from s)::double as total from o),
l as (select min(k) as k from c where cap >= w * ((total - cut) / rest)),
m as (select (total - cut) / rest as level from c where k = (select k from l)),
t as (select o.source, o.source_size, case when o.w * level > o.cap then o.cap else o.w * level end::double as target
       from o, m),
p as (select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from t),
q as (select d.doc_id, d.size, p.source_size, p.target, floor(rate)::bigint as whole,
             (rate - floor(rate)) * p.source_size as extra,
             coalesce(sum(d.size) over (partition by d.source order by d.h, d.doc_id, d.size
               rows between unbounded preceding and 1 preceding), 0)::double as prior
      from d join p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       ((whole + case when extra > 0 and 2 * prior + size <= 2 * extra then 1 else 0 end) * size)::bigint as taken
from q"""


@query("op9_mixing", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of all words, weights 5, 2, 1, at most two epochs."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


@query("op4_warc_normaliser")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a monolithic archive, its normalised form and back."""
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_wrapper_induction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query("op10_cross_polytope")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with one label and a cosine of 0.98 or more."""
    return crosspolytope.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op5_backoff_automaton")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents, learnt from folds other than 1 of 5."""
    return lm.score(table(spark, sf_dir, "documents"))


@query("op3_separator_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found in flat token files."""
    return tokenfiles.token_counts(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both vocabularies' tokens of every document aligned, with corpus-wide counts of linked id pairs."""
    return crosstok.align(table(spark, sf_dir, "documents"))


@query("op12_longest_previous_factor")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings that an earlier document has."""
    found = factors.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("span_starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


_OP13_ROUND = """,
a{r} as materialized (select rid, arg_min(c, (s, c)) as c, min(s) as s from (
        select rid, c, sum((v.x - m.x) * (v.x - m.x)) as s from v join c{r} m using (d) group by rid, c) group by rid)"""
_OP13_MOVE = """,
m{r} as (select c, d, sum(x) as s, count(*) as n from v join a{p} using (rid) group by c, d),
c{r} as materialized (select c, d, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, o.x) as x
      from c{p} o left join m{r} m using (c, d))"""
OP13_SQL = ("""
with k as materialized (select row_number() over (order by vec_id) as rid, vec_id,
             list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as q
      from embeddings
      where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
v as materialized (select rid, unnest(q) as x, generate_subscripts(q, 1) as d from k),
f as (select row_number() over (order by sha256('1:' || vec_id::varchar), q) - 1 as c, rid
      from k where vec_id is not null),
c0 as materialized (select c, d, x from v join f using (rid) where c < 16)"""
            + _OP13_ROUND.format(r=0) + "".join(_OP13_MOVE.format(r=r, p=r - 1) + _OP13_ROUND.format(r=r) for r in (1, 2, 3))
            + """,
h as (select c, sha256(string_agg(x::varchar, ',' order by d)) as centroid_sha256 from c3 group by c),
i as (select c, sum(s) as own from a3 group by c)
select k.vec_id, a3.c::int as cluster, a3.s::bigint as distance, i.own::bigint as cluster_inertia,
       (select sum(own) from i)::bigint as inertia, centroid_sha256
from k join a3 using (rid) join h using (c) join i using (c)""")


@query("op13_lookup_tables", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer vectors in 16 clusters after three rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))
