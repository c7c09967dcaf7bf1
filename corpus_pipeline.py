"""Corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet below the shared checkpoint folder and reads it again as
the next stage's docs.  All but the last return the columns of documents.

Edge cases: an empty table goes through all stages as one (without labels no
document is rejected, without benchmark items none is contaminated).  Other
columns of documents, whatever their names, are carried along unchanged by all
stages but the last; work columns have names that are free.  Very long texts
are judged, fingerprinted, scanned and encoded whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.bpe import encode_documents
from tierline.llm.common import free_name, read_table
from tierline.llm.decontaminate import decontaminate
from tierline.llm.queries import tokenizer_path
from tierline.llm.secrets import redact
from tierline.llm.simhash import keep_one
from tierline.llm.toxicity import train
from tierline.sources.sinks import stage_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier calls toxic.  Null and empty texts
    have a score as well and stay unless the classifier is biased to reject
    them; repeated rows have equal scores, so all or none stay."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    found = free_name("found", docs.columns)
    scored = docs.withColumn(found, model.logits(F.col("text")))
    return scored.where(model.score(F.col(found)) < 0.5).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component: the smallest id's.  Repeated
    rows are one component, rows without an id go if another row of theirs has
    one; null and empty texts have fingerprint zero and are near each other."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that benchmark passages make up too much of.  Null and
    empty texts have no words and stay; repeated rows are judged alike."""
    # Other names inside, so that no input column clashes with a result.
    inner = {c: f"doc_{i}" for i, c in enumerate(docs.columns)}
    judged = decontaminate(
        docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in docs.columns]),
        read_table(spark, sf_dir, "benchmark"),
        id_col=inner["doc_id"],
        text_col=inner["text"],
    )
    return judged.where(~F.col("contaminated")).select(*[F.col(inner[c]).alias(c) for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts.  Null and empty texts stay as they are;
    ``n_chars``, where there is one, is that of the new text."""
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left: doc_id, n_tokens, ids.  Null and
    empty texts have none; repeated rows have a row each."""
    encoded = encode_documents(docs, tokenizer_path())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("bpe", bpe),
]

# The classifier and the fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
