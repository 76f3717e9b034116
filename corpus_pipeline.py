"""The stages that turn ``documents`` into encoded training text.

``run`` applies them one after another; each stage's rows are written as Parquet and read again, so
a lost executor costs part of one stage; those of the stage before are deleted then. Every stage works on all that its predecessor kept. All but
the last return the columns of their input; a stage's own columns start with ``_``.

Cases, beside those of each operator: an empty table goes through all stages as an empty table; a
null text is kept until the end, where it counts as empty; rows with a null id are judged by their
text where that needs no other row, decontamination included, and are kept by the join; of rows with one
id the join keeps one with words and those without; columns of any name stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.llm import decontaminate, jaccard_join, line_dedup, queries, toxicity
from skyops.session import cut_at, prepare, remove


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, longer where the table has them."""
    return [next(n + "_" * k for k in range(len(docs.columns) + 1) if n + "_" * k not in docs.columns) for n in names]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict toxic; it learns from ``labels`` of the documents here."""
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    score, predicted = _free(docs, "_score", "_predicted")
    scored = toxicity.score(docs, model, score=score, predicted=predicted)
    return scored.where(F.col(predicted) == 0).drop(score, predicted)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the lines that are near an earlier one; documents with nothing left of their text go."""
    return line_dedup.without_repeats(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of similar ones; texts without words belong to no group."""
    (key,) = _free(docs, "_key")
    found = jaccard_join.join(docs).where("n_shingles > 0 and doc_id = component_id").select("doc_id").distinct()
    grouped = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    first = rows.where(grouped).groupBy("doc_id").agg(F.min(key).alias(key)).join(found, "doc_id", "left_semi")
    kept = rows.where(grouped).join(first, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return kept.unionByName(rows.where(~grouped)).drop(key)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    items = decontaminate.with_answers(queries.table(spark, sf_dir, "benchmark"))
    (key,) = _free(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))  # rows with no id or a repeated one by their own text
    found = decontaminate.find(keyed, items, doc_id=key).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left."""
    return queries.pieces_digests(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("jaccard_join", one_of_each_group),
          ("decontamination", drop_leaks), ("sentencepiece", encode)]
#: no SQL expresses the learned and approximate stages; tests hold each against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = str(sf_dir).rstrip("/")
    docs = queries.table(prepare(spark), sf_dir, "documents")
    before = []
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, at = cut_at(docs)
            remove(spark, *before)
            before = [at]
    return docs
