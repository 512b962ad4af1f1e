"""The text pipeline: reject, deduplicate, mix and encode documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import pack, table
from tidewatch.llm.jaccard_join import keep_first
from tidewatch.llm.language_id import UNKNOWN, identify
from tidewatch.llm.mix import mix
from tidewatch.llm.quality_model import classify
from tidewatch.llm.sentencepiece_codec import encode_documents
from tidewatch.session import work_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents over their language's line of perplexity, and those without a word.

    Null, empty and blank texts go; an unknown language takes the line of all. Repeated rows
    are judged alike, a text of any length whole. Every column comes back as it was, whatever
    its name; an empty table stays empty.
    """
    packed, unpack = pack(docs, "doc_id", "text", "lang")
    return unpack(classify(packed, table(spark, sf_dir, "labels")).where("kept"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language: no letter, or a score below one half.

    Null and empty texts go. Repeated rows are judged alike, every window of a long text counts.
    Every column comes back as it was; an empty table stays empty, as does one without
    any known language.
    """
    packed, unpack = pack(docs, "doc_id", "text", "lang")
    named = identify(packed)
    return unpack(named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= 0.5)))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, similarity 0.8).

    Documents without words link with nothing and stay. Of a group, and of repeated rows, the
    smallest doc_id stays, a null one last. Columns come back as they were; an empty table
    stays empty.
    """
    return keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources reach their target shares.

    Null and wordless texts have size 0 and no copies; a null source is a source. Rows of one id,
    size and text are interchangeable. Columns come back as they were; an empty table stays empty.
    """
    return mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null text is empty and has the end id alone. Rows are encoded one by one, whole; other columns
    are not read, and an empty table gives an empty result.
    """
    return encode_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing sources", mix_sources),
    ("SentencePiece", sentencepiece),
]

#: The models, the network and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
