"""From raw documents to packed sequences: rules, toxicity, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import jaccard, mixing, packing, rules, toxicity
from loomstat.llm.queries import token_length, toxicity_model
from loomstat.llm.tables import packed, table, unpacked
from loomstat.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass every rule of the strict policy."""
    rows = packed(docs, body=F.col("text"))
    return unpacked(rules.kept(rules.ledger(rows, "body", row=F.col("row")), rules.STRICT))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the toxicity model, learned from the labelled ones, does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose 5-word shingle sets are alike by 0.8 or more."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of a mix of their sources at tempered weights."""
    placed = mixing.mix(docs, row=F.struct("*"))
    return placed.orderBy("position").select("row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, in tokens, in sequences of permitted lengths, each filled from one stretch of the mix.

    The mix was written in order, so rows that follow each other in a file are neighbours in it.
    Rows that come from no file are packed in groups dealt at random.
    """
    stretch = None
    if docs.inputFiles():
        chunk = F.floor(F.col("_metadata.row_index") / packing.GROUP_PIECES)
        file = F.col("_metadata.file_name")
        part = F.regexp_extract(file, r"^part-(\d+)", 1)  # what follows it is another text in every run
        stretch = F.concat_ws("/", F.when(part != "", part).otherwise(file), chunk)
    return packing.pack(docs, token_length(spark), group=stretch)


STAGES = [
    ("quality", quality),
    ("toxicity", clean),
    ("near-duplicates", distinct),
    ("mixing", mixed),
    ("packing", sequences),
]

# The toxicity model is trained in numpy: no SQL gives the rows of the whole run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
