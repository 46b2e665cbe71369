"""From raw documents to token ids: five stages over documents, each an operator of millrace.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, language, lines, neardup, sentencepiece
from millrace.llm.tables import load, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in which no language is recognised go.

    These are NULL, empty and letterless texts, and those without the n-grams of the language
    that comes out best, such as texts in another script or of random letters. Learns from the documents that are not held out; if none has a
    language, nothing is known and only texts without a letter go.
    """
    model = language.fit(docs.where(~language.held_out()))
    scored = language.with_language(docs.select(*COLUMNS), model, out="_lang", out_score="_score", out_known="_known")
    if not model.languages:
        return scored.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    return scored.where("_known").select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that ten documents or more share go from every text; ``n_chars`` follows.

    Documents stay, also those that had only such lines; NULL text becomes ``''``.
    """
    kept = lines.drop_shared_lines(docs.select(*COLUMNS))
    return kept.withColumn("text", F.col("kept")).withColumn("n_chars", F.char_length("kept").cast("bigint")).select(*COLUMNS)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: of each class the document with the smallest id stays.

    Rows that repeat an id are one document: all its different texts stay or go with it, and of rows that
    repeat id and text one stays. Documents without id are in no class and stay.
    """
    docs = docs.select(*COLUMNS)
    classes = neardup.near_duplicates(docs)
    first = classes.where("doc_id = class_id").select("doc_id")
    named = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)
    return named.unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that contain an item of the benchmark go."""
    docs = docs.select(*COLUMNS)
    hits = decontaminate.contaminated(docs, load(spark, sf_dir, "benchmark"))
    found = hits.select(F.col("doc_id").alias("_doc")).distinct()
    return docs.join(found, docs.doc_id.eqNullSafe(found["_doc"]), "left_anti").select(*COLUMNS)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: token ids of every text, their number, and whether they decode to the text."""
    coded = sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), out_decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_one_of_each_class),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_and_decode),
]

ORACLE_SQL = None  # near-duplicate classes and the learned language model have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
