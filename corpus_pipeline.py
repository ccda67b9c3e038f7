"""From raw documents to packed sequences, in stages; each is written and read again before the next.

1. language ID: documents without a language go;
2. near-dedup: one document of each group stays;
3. secret scans: credentials are masked in the texts;
4. mixing: each source gives its target of words, documents repeat as often as the mix takes them;
5. packing: texts become pieces of sequences.

Every stage takes the columns of documents and, but for the last, returns them. The pipeline has no SQL twin: a
classifier, fingerprint components and a tokenizer are not SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.llm import lang, mixing, packing, secret_scan, simhash, tokens
from bibspark.llm.queries import small_batches
from bibspark.session import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Null texts and those without a letter go; repeated rows and null ids stay."""
    small_batches(spark)
    return lang.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; texts without words are one group."""
    small_batches(spark)
    return simhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span in a text replaced by a mask and n_chars counted anew; null texts stay null."""
    return secret_scan.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, so ids repeat; the null source is a source of its own."""
    return mixing.Mix(docs).texts()


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece its document, place and ids, as bytes of little-endian unsigned 32-bit numbers: ``packing.sequences`` puts the
    sequences together. A null text is the end id alone; each copy of a document is packed."""
    small_batches(spark)
    cut = tokens.pieces(docs, packing.TOKENS).withColumn("ids_crc32", F.crc32("ids"))
    return packing.packed_ids(cut)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
