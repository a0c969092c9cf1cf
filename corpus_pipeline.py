"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all rows it gets, and returns a DataFrame; ``run`` writes each result as
Parquet to the shared scratch folder and hands the reread table to the next stage. All stages but the last return the
columns of ``docs``.
"""

from kerbline.llm import bpe, exact_dedup, mixing, quality, simhash
from kerbline.llm.frames import table, written


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and are near a language reference; references come from the stage's input."""
    return quality.passing(docs, quality.references(docs))


def exact_dedup_stage(spark, docs, sf_dir):
    """One row of each group of equal texts."""
    return exact_dedup.distinct_texts(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each component of fingerprints: three-word shingles, at most three differing bits."""
    return simhash.distinct_groups(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def mixing_stage(spark, docs, sf_dir):
    """Documents in training order, each as often as the mix takes it."""
    return mixing.mix(docs).select("doc.*")


def byte_bpe(spark, docs, sf_dir):
    """Token ids and decoded text of every document, as digests."""
    return bpe.digests(bpe.round_trip(docs.select("doc_id", "text")).drop("text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing_stage),
    ("byte_bpe", byte_bpe),
]

#: Fingerprints and byte-pair merges cannot be said in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
