"""The registered query of each operator: production parameters, whole tables."""

from pyspark.sql import functions as F

from kerbline.llm import (
    alignment,
    bloom_lm,
    bpe,
    exact_dedup,
    html_text,
    jaccard,
    langid,
    mixing,
    periodic,
    quality,
    simhash,
    suffix_dedup,
    url_filter,
)
from kerbline.llm.frames import table


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.crc_remainder(F.col("doc_id"), 3) == 1)
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op2_simhash(spark, sf_dir):
    return simhash.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    out = exact_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train(pages)).drop("html")


def op7_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, quality.references(docs)).drop("text", "lang")


def op8_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", langid.crc_remainder(F.col("doc_id"), 10) == 0)
    return bloom_lm.score(docs.withColumn("learn", ~F.col("held_out")), "learn").drop("learn")


def op9_url_filter(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(urls, url_filter.feed(urls)).select("page_id", "host", "path", "rule", "verdict")


def op10_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.decode(bpe.encode(docs).drop("text")))


def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_periodic_runs(spark, sf_dir):
    return periodic.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_url_filter": op9_url_filter,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_periodic_runs": op13_periodic_runs,
}
