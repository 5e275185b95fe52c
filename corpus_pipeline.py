"""The training-data pipeline: operators of `meterlark.llm` in stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stages before it have kept.
All but the last return the columns of their input. Null and empty texts are scored like any
other text, are near copies of nothing and hold nothing, and are encoded to no ids. Of rows that
repeat an id, the near-duplicate stage keeps one. An empty table passes through as one. Documents
may have further columns; the names `_q_content` and `_q_meta` are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark.llm import bpe, decontam, minhash, quality, toxicity
from meterlark.llm.common import table
from meterlark.llm.queries import WORD_BPE
from meterlark.session import materialize

#: Probability of a toxic text from which a document goes, and of good quality below which it goes.
TOXIC_FROM, GOOD_FROM = 0.5, 0.5


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def _not_labelled(spark: SparkSession, docs: DataFrame, sf_dir: str, label: str, rejected: int) -> DataFrame:
    """Documents whose own label is not the rejected one; of contradicting labels the largest counts."""
    labels = table(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id").agg(F.max(label).alias("_own"))
    ids = labels.where(F.col("_own") == rejected).select("doc_id")
    few = ids.count() <= toxicity.BROADCAST_LABELS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not scored as toxic. Without labels of both classes only a document's own label counts."""
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels"), "toxic"), pairs=True)
    if not model.known:
        return _not_labelled(spark, docs, sf_dir, "toxic", 1)
    column = _free(docs, "_toxic")
    return toxicity.score(docs, model, to=column).where(F.col(column) < TOXIC_FROM).drop(column)


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that both views together do not score as bad. Without labels of both classes only a document's own label counts."""
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels"), F.lit(True)))
    if not model.known:
        return _not_labelled(spark, docs, sf_dir, "quality", 0)
    column = _free(docs, "_score")
    return quality.score(docs, model, to=column).where(F.col(column) >= GOOD_FROM).drop(column)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return minhash.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    column = _free(docs, "_held")
    marked = decontam.mark(docs, table(spark, sf_dir, "benchmark"), to=column)
    return marked.where(F.size(column) == 0).drop(column)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document that is left."""
    return bpe.encode(docs, WORD_BPE, lexicon=bpe.fit_lexicon(docs, WORD_BPE))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_good_quality),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe_encoding", encoded),
]

#: The classifiers and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
