"""The registered queries: each applies its operator, with production
parameters, to its whole table and derives the columns of its contract."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table
from tierline.llm.oracle import ORACLE as ORACLE  # for the driver contract


def tokenizer_path() -> str:
    """The public vocabulary file that the BPE query encodes with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_path() -> str:
    """The public model file that the SentencePiece query encodes with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _count(values: Column, field: str, value: str) -> Column:
    """How many structs of an array have a value in a field."""
    return F.size(F.filter(values, lambda v: v[field] == value)).cast("long")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from tierline.llm.html import extract

    out = extract(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, also inside nested encodings."""
    from tierline.llm.secrets import KINDS, find_secrets

    out = find_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["depth"] == 0)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return out.select(
        "doc_id",
        *[_count(base, "kind", k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours of every vector whose id is divisible by 50."""
    from tierline.llm.hnsw import nearest

    table = read_table(spark, sf_dir, "embeddings")
    return nearest(table, table.where(F.col("vec_id") % 50 == 0), k=5)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    from tierline.llm.toxicity import fold, train

    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", model.logits(F.col("text")).alias("found"))
    scored = found.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), model.score(F.col("found")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents covered by 13-word windows of benchmark items."""
    from tierline.llm.decontaminate import decontaminate

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from tierline.llm.simhash import near_duplicates

    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    from tierline.llm.warc import archive

    out = archive(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data.  The key is the
    session's ``spark.tierline.pii.key``; without one a fresh key is drawn, and
    nobody can undo the run's surrogates."""
    from tierline.llm.pii import TYPES, pseudonymize

    key = spark.conf.get("spark.tierline.pii.key", None)
    out = pseudonymize(read_table(spark, sf_dir, "documents"), key.encode() if key else os.urandom(32))
    counts = [_count(F.col("entities"), "type", t).alias(f"n_{t}") for t in TYPES]
    return out.select("doc_id", "text", *counts)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    from tierline.llm.bpe import encode_documents

    out = encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL.  A page has the label of the document with
    its id: bad, if that is of low quality or toxic."""
    from tierline.llm.url_rules import judge, mine

    pages = read_table(spark, sf_dir, "pages")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    rules = mine(pages.select(F.col("page_id").alias("id"), "url"), labels)
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry numbers, errors and codebooks of the compressed embeddings."""
    from tierline.llm.codes import compress, with_label_error

    out = compress(read_table(spark, sf_dir, "embeddings"))
    return with_label_error(out.rows).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(out.books_sha256()).alias("codebooks_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of the documents, checked against tampered rows."""
    from tierline.llm.merkle import document_manifest, fold, siblings

    out = document_manifest(read_table(spark, sf_dir, "documents"))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return out.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every document, as digests."""
    from tierline.llm.pieces import encode_pieces

    out = encode_pieces(read_table(spark, sf_dir, "documents"), pieces_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_html": op1_html,
    "op2_secrets": op2_secrets,
    "op3_hnsw": op3_hnsw,
    "op4_toxicity": op4_toxicity,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_bpe": op9_bpe,
    "op10_urls": op10_urls,
    "op11_codes": op11_codes,
    "op12_merkle": op12_merkle,
    "op13_pieces": op13_pieces,
}
