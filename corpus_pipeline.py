"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

Toxic documents go; of equal and of nearly equal texts one document stays; sources are mixed to their
weights; what is left is packed into training sequences.
"""

from pyspark.sql import functions as F

from lurewatch.llm import exact_dedup, mixing, near_dedup, packing, queries, toxicity
from lurewatch.session import shared_dir


def drop_toxic(spark, docs, sf_dir):
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, sf_dir, docs))


def drop_copies(spark, docs, sf_dir):
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark, docs, sf_dir):
    return near_dedup.keep_one(docs)


def mix_sources(spark, docs, sf_dir):
    """One epoch, nine tenths of the tokens: weights decide which tenth is left out."""
    domain = mixing.numbered_domain(F.col("source"))
    return mixing.mixed(docs, domain, epochs=1, **{**queries.MIX, "budget_share": 0.9}).select("row.*")


def pack(spark, docs, sf_dir):
    return packing.pack_documents(docs, queries.vocabulary_path(), added=queries.added_tokens())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]
# The first, third and last stage cannot be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to documents; returns the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
