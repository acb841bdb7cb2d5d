"""A corpus made ready for training: five stages, each on all that the one before it kept."""

from pyspark.sql import DataFrame, SparkSession

from wattframe.llm.common import prepare, table, written
from wattframe.llm.exact_dedup import drop_copies
from wattframe.llm.mixing import mixed_documents
from wattframe.llm.ngram_join import drop_similar
from wattframe.llm.packing import pack_documents
from wattframe.llm.quality import keep_good
from wattframe.llm.queries import CURRICULUM, TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on them without labels, doesn't reject."""
    prepare(spark)
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest doc_id."""
    prepare(spark)
    return drop_copies(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest doc_id: 5-word shingles, 0.8 in common."""
    prepare(spark)
    return drop_similar(docs, words=5, least=80, of=100)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them, in the order of use."""
    prepare(spark)
    return mixed_documents(docs, CURRICULUM)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024."""
    prepare(spark)
    return pack_documents(docs, TOKENIZER, capacity=1024, end_id=2)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

#: The classifier is trained by expectation-maximisation, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the whole table of documents; every stage is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
