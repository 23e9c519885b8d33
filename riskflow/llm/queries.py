"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.alignment import Vocabularies, align, pair_counts
from riskflow.llm.alignment import scored as alignment_scored
from riskflow.llm.common import id_remainder, table, with_code
from riskflow.llm.decontaminate import contamination
from riskflow.llm.language import train as train_languages
from riskflow.llm.language import with_languages
from riskflow.llm.packing import pack
from riskflow.llm.pii import KINDS, with_spans
from riskflow.llm.quality import scored as quality_scored
from riskflow.llm.sharding import sharded
from riskflow.llm.simhash import near_duplicates
from riskflow.llm.topk import quantised, top_k
from riskflow.llm.toxicity import train as train_toxicity
from riskflow.llm.toxicity import with_scores
from riskflow.llm.token_files import read_documents, write_token_files
from riskflow.llm.tokens import vocabulary_path
from riskflow.llm.urls import Rule, judged, labelled_by_rules
from riskflow.llm.urls import train as train_urls
from riskflow.llm.whitening import whiten
from riskflow.session import scratch_dir


TOXIC_FROM = 0.3


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    return with_scores(docs, model).select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "sentences",
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", quantised(F.col("embedding")).alias("vector")
    )
    return top_k(vectors.where("vec_id % 50 = 0"), vectors, 5)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [k.name for k in KINDS if k.base]

    def of(kind: str):
        return F.filter("all", lambda s: s["kind"] == kind)

    def listed(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(each, ",")

    return found.select("doc_id", F.col("__spans").alias("all")).select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(F.filter("all", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "op4")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary_path(), end_id=1)
    return read_documents(spark, folder)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.withColumn(
        "fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    found = with_languages(docs, train_languages(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


URL_RULES = [
    Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = train_urls(labelled_by_rules(pages, URL_RULES))
    return judged(pages, URL_RULES, model).drop("url")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 3) == 1
    found = quality_scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), vocabulary_path(), end_id=2)
    return packed.withColumns({
        "length": (F.octet_length("ids") / 4).cast("long"), "ids_crc32": F.crc32("ids"),
    }).drop("ids")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, model = whiten(table(spark, sf_dir, "embeddings"), components=4)
    explained = F.array(*[F.lit(float(share)) for share in model.explained])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", explained[F.col("at")].alias("explained"),
        F.lit(model.error).cast("double").alias("identity_error"),
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    aligned, vocab = align(table(spark, sf_dir, "documents"), *paths), Vocabularies.of(*paths)
    found = alignment_scored(aligned, pair_counts(aligned, vocab), vocab)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


LLM_QUERIES = {query.__name__: with_code(query) for query in (
    op1_toxicity, op2_topk, op3_pii, op4_token_files, op5_simhash, op6_language, op7_urls,
    op8_quality, op9_packing, op10_decontamination, op11_whitening, op12_sharding, op13_alignment,
)}
WORDS = r"""
    list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')
"""

LLM_ORACLE = {
    "op2_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
            from embeddings where embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
        ),
        s as (
            select q.vec_id as query_id, d.vec_id,
                list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * d.w[i]))::bigint
                    as score
            from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0
        ),
        r as (
            select query_id, row_number() over (
                partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
            from s
        )
        select * from r where rank <= 5
    """,
    "op10_decontamination": f"""
        with d as (select doc_id, coalesce({WORDS}, []) as words from documents),
        i as (select item_id, {WORDS} as words from benchmark where text is not null),
        w as (
            select distinct item_id, len(words[s:s + 9]) as n, words[s:s + 9] as phrase
            from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as s
                  from i where len(words) > 0)
        ),
        lengths as (select distinct n from w),
        g as (
            select doc_id, n, s, words[s:s + n - 1] as phrase
            from (select doc_id, n, words, unnest(range(1, len(words) - n + 2)) as s
                  from d, lengths where len(words) >= n)
        ),
        m as (select distinct doc_id, item_id, n, s from g join w using (n, phrase)),
        hit as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(s, s + n)) as p from m) group by doc_id
        ),
        items as (
            select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as h
            from (select distinct doc_id, item_id::varchar as item from m) group by doc_id
        )
        select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
            coalesce(n_items, 0)::bigint as n_items, coalesce(h, sha256('')) as items_sha256,
            coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit using (doc_id) left join items using (doc_id)
    """,
}
