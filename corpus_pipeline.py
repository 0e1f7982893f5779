"""From raw documents to packed training sequences, as five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from pulse.llm import kk_packing, line_quality, near_dups, secret_tags, toxic_lexicon
from pulse.session import shared_folder


def quality(spark, docs, sf_dir):
    """Documents that fail the quality rules go, and so do lines that a host's texts share."""
    return line_quality.keep_good(docs)


def toxicity(spark, docs, sf_dir):
    """Documents that score as toxic go."""
    return toxic_lexicon.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return near_dups.keep_one(docs)


def secrets(spark, docs, sf_dir):
    """Secrets in texts are masked."""
    return secret_tags.mask_secrets(docs)


def packing(spark, docs, sf_dir):
    """Pieces of sequences of at most 4096 ids."""
    return kk_packing.packed_digest(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

# Scores, tags and ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
