"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflume.llm import bwtmerge, langid, neardup, packing, pieces, pii, quality, simhash, spelling, suffixtree, topk, toxicity, whitening
from orderflume.llm.common import table


def packing_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), piece_model())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing_tokenizer())


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", 10)


def op8_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwtmerge.digest(bwtmerge.remove_repeats(table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_suffix_tree": op4_suffix_tree,
    "op5_pieces": op5_pieces,
    "op6_packing": op6_packing,
    "op7_topk": op7_topk,
    "op8_pivots": op8_pivots,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_repeats": op12_repeats,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

#: What SQL can say in full; the learned, hashed and tokenized ones are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op7_topk": """
        with scaled as (
          select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
          where vec_id is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), queries as (select vec_id as query_id, v as q from scaled where vec_id % 100 = 0),
        scores as (
          select query_id, vec_id, cast(list_sum(list_transform(list_zip(q, v), lambda p: p[1] * p[2])) as bigint) as score
          from queries join scaled on query_id <> vec_id
        ), ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scores)
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
    "op12_repeats": """
        with d as (select row_number() over (order by doc_id, text) as row, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        c as (select row, doc_id, b, substr(h, 2 * b + 1, 610) as c from (select *, unnest(range(0, length(h) // 2 - 49, 256)) as b from d)),
        w as (select row, doc_id, b + j as i, substr(c, 2 * j + 1, 100) as s from (select *, unnest(range(0, least(256, length(c) // 2 - 49))) as j from c)),
        f as (select s, min(doc_id) as least from w group by s),
        g as (select row, i from w join f using (s) where least < doc_id),
        m as (select *, max(i + 50) over (partition by row order by i rows between unbounded preceding and 1 preceding) as reach from g),
        k as (select *, sum(case when reach is null or i > reach then 1 else 0 end) over (partition by row order by i) as run from m),
        r as (select row, run, min(i) as a, max(i) + 50 as b from k group by row, run),
        e as (select row, a, b, lag(b, 1, 0) over (partition by row order by a) as before from r),
        x as (select row, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last from e group by row),
        p as (select e.row, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head from e join d using (row) group by e.row)
        select doc_id, length(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
          sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
        from d left join x using (row) left join p using (row)
    """,
}
