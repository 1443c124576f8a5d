"""From raw documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept; its result is written to the cluster's
shared folder and read again, so a lost executor costs at most one stage's work.  A
predecessor's folder goes when its successor's is written.

Every stage takes nulls in any column, empty and long texts, repeated rows, extra columns of
any name and empty tables; all but the last keep the columns of ``docs``.
"""

from __future__ import annotations

import uuid

from lapworks.llm import exact_dedup, jaccard, mixing, packing, toxicity
from lapworks.llm.common import prepare, table
from lapworks.session import remove_folder, shared_dir


def drop_toxic(spark, docs, sf_dir):
    """Documents predicted toxic go (classifier fitted on the labels beside them).  Null and
    empty texts have the score of no evidence and stay; without labels of both kinds all do."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts (but for A-Z case) the one with the smallest id stays.  Null texts are
    equal to empty ones; rows without id stay only where no row of the group has one."""
    return exact_dedup.drop_copies(docs, keep="smallest")


def drop_near_copies(spark, docs, sf_dir):
    """Of each group that word 5-grams link at a Jaccard of 0.8, the smallest id stays.
    Texts without words are linked with nothing and stay; rows that share an id go together."""
    return jaccard.one_per_component(docs)


def mix_sources(spark, docs, sf_dir):
    """Sources at their target weights: documents repeated, left out, one a source cut.  A
    null source is a source; texts without words are never taken."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """Token ids of the mix in sequences of 4096, one row a piece.  A null text is empty:
    its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Not expressible: a fitted classifier, hashed sampling keys, byte-pair encoding.
ORACLE_SQL = None


def run(spark, sf_dir):
    prepare(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
