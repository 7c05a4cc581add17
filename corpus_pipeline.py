"""From raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; a document is identified by its ``doc_id``.
"""

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.cotraining import keep_good, train_quality
from hirelake.llm.mixing import mix_sources
from hirelake.llm.packing import Limits, pack_documents
from hirelake.llm.parity import jaccard_components
from hirelake.llm.pii import find_personal_data, masked
from hirelake.scratch import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    docs = docs.select(COLUMNS)
    return keep_good(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that is linked by shingles
    of five words at a similarity of 0.8. Of rows that share an id the first by
    its other columns stays; documents without an id all stay."""
    docs = docs.select(COLUMNS)
    parts = jaccard_components(docs, 5, 80)
    stay = parts.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    first = Window.partitionBy("doc_id").orderBy("text", "source", "lang", "n_chars")
    kept = (
        docs.join(stay, F.col("doc_id") == F.col("_id"), "left_semi")
        .withColumn("_nth", F.row_number().over(first))
        .where("_nth = 1")
    )
    return kept.select(COLUMNS).unionByName(docs.where(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    found = find_personal_data(docs).where(F.size("spans") > 0)
    spans = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans").distinct()
    hash_ = F.xxhash64(F.coalesce("text", F.lit("")))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col("spans")))
    return (
        docs.select(COLUMNS)
        .join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (hash_ == F.col("_hash")), "left")
        .withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(COLUMNS)
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget asks for, the one at the budget's
    edge also cut to its first words. Every row has its own uses, whatever it shares
    with others."""
    space, word = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    mixed = mix_sources(docs.select(COLUMNS), (5, 2, 1), 1.5, 2, keep=("text", "lang", "n_chars"))
    begin = F.concat(
        F.lit(f"^{space}*+(?:{word}++{space}++){{"), (F.col("cut") - 1).cast("string"), F.lit(f"}}+{word}++")
    )
    none = F.array().cast("array<int>")
    # -1: the beginning of the document; 1, 2, ...: the whole of it
    times = F.concat(
        F.when(F.col("epochs") > 0, F.sequence(F.lit(1), F.greatest("epochs", F.lit(1)).cast("int"))).otherwise(none),
        F.when(F.col("cut") > 0, F.array(F.lit(-1))).otherwise(none),
    )
    text = F.when(F.col("_use") < 0, F.regexp_substr("text", begin)).otherwise(F.col("text"))
    return (
        mixed.withColumn("_use", F.explode(times))
        .withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(COLUMNS)
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 1, Limits(2048, 64, 2048), by_word=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
