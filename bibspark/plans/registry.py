"""Registry of queries and the tables they read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.operators.searchtable import SearchTable, add_lookups, build
from bibspark.session import scratch

QUERIES: dict = {}

TABLE_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` with its SQL twin."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = (fn, sql)
        return fn

    return add


TEXT_TABLES = ("documents", "pages")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than the cluster has cores, as a table in one small file
    does; a table of many files is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


# search tables by session, folder and kind: stored by the first query that reads them, as a catalogue stores its own once
_STORED: dict = {}


class Tables:
    """Lazy readers of the tables under one folder; ``tables.orders`` is a DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.files(name)
        return spread(df) if name in TEXT_TABLES else df

    def files(self, name: str) -> DataFrame:
        """A table as its files lie, for jobs that deal out its rows themselves."""
        return self.spark.read.parquet(self.path(name))

    def search_table(self, exact: bool = True, lookups: str | None = None) -> SearchTable:
        """The search table of documents: text, source and lang; with the lookups for words by likeness (``deletes``) or pattern (``grams``)."""
        key = (self.spark.sparkContext.applicationId, self.folder, exact)
        if key not in _STORED:
            _STORED[key] = build(self.files("documents"), "doc_id", ["text", "source", "lang"], scratch(self.spark, "search"), exact)
        return add_lookups(_STORED[key], lookups) if lookups else _STORED[key]

    @property
    def works(self) -> DataFrame:
        """Nested records: each document with its sentences as an array of structs. Built inside the
        row, so no shuffle and no group is collected. ``mark`` is missing where a sentence ends in a
        full stop; ``terms`` is an array in an array."""
        lines = F.split("text", "\n")

        def sentence(line, i):
            return F.struct(
                (i + 1).alias("no"),
                F.size(F.split(line, " ")).alias("words"),
                F.lower(F.split_part(line, F.lit(" "), F.lit(1))).alias("opener"),
                F.nullif(F.right(line, F.lit(1)), F.lit(".")).alias("mark"),
                F.split(F.lower(line), " ").alias("terms"),
            )

        return self.documents.select(
            F.col("doc_id").alias("id"),
            "lang",
            F.struct(F.col("source").alias("id"), F.nullif(F.col("source"), F.lit("src3")).alias("name")).alias("source"),
            F.col("n_chars").alias("cited_by_count"),
            # a generator keeps the optimizer from repeating the array in every use of it
            F.explode(F.array(F.transform(lines, sentence))).alias("sentences"),
        )


# the same nested records in the checking engine
WORKS = """
works as (
  select doc_id as id, lang, {'id': source, 'name': nullif(source, 'src3')} as source,
    n_chars as cited_by_count,
    list_transform(string_split(text, chr(10)), lambda l, i: {
      'no': i, 'words': len(string_split(l, ' ')), 'opener': lower(split_part(l, ' ', 1)),
      'mark': nullif(right(l, 1), '.'), 'terms': string_split(lower(l), ' ')}) as sentences
  from documents)
"""


def with_works(sql: str, *more: str) -> str:
    return "with " + ",".join([WORKS, *more]) + sql
