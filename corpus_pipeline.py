"""A training corpus from documents, in five stages; each one works on all that the one before kept.

Texts that change get a new n_chars. ORACLE_SQL is None: stages here have no SQL form, and tests compare them with plain
Python instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import read, saved, small
from arpent.llm.jaccard import near_duplicates
from arpent.llm.packing import pack_documents
from arpent.llm.secrets import redact, scan_secrets
from arpent.llm.substring_dedup import remove_repeats
from arpent.llm.toxicity import THRESHOLD, fit, likelihood


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; learned from labels outside the held-out fold.

    Null and empty texts have no evidence and stay, as do repeated rows, each by its own text.
    """
    model = fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(likelihood(spark, model)("text") < THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates; rows without id stay.

    Of repeated rows (one id and text) one stays. Only the ids to go are joined: broadcast while few, else by shuffle.
    """
    groups = saved(near_duplicates(docs).where("doc_id IS NOT NULL"), "groups")
    gone = saved(groups.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    repeated = saved(groups.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    kept = docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    once = kept.join(small(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(small(repeated), "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def _sized(docs: DataFrame, before: list[str]) -> DataFrame:
    if "n_chars" not in before:
        return docs.select(*before)
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*before)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that another document keeps; a document of which nothing is left goes."""
    out = remove_repeats(docs.withColumn("__arpent_had", F.length(F.trim("text")) > 0))
    out = out.where((F.length(F.trim("text")) > 0) | ~F.coalesce("__arpent_had", F.lit(False)))
    return _sized(out, docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark; null and empty texts stay as they are, as do columns of any name."""
    return _sized(redact(scan_secrets(docs, found="__arpent_secrets"), found="__arpent_secrets"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences; a null or empty text is one piece of its end id."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
