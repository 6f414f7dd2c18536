"""Corpus pipeline: toxicity, near duplicates, decontamination, secrets, packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. Rows that a stage's operator does not reject stay as
they are: null and empty texts are neither toxic nor contaminated nor duplicates, ties
and repeated rows stay together, an empty table gives empty stages, texts are read whole
whatever their length, and extra columns stay, also those named like an operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoflux.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity
from genoflux.llm.common import discard, materialize, scratch, table

#: Near duplicates: five-word shingles, Jaccard similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names that no operator uses, and the new name of each column."""
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    lexicon, model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    apart, names = _apart(docs)
    return _back(toxicity.score(apart, lexicon, model, text_col=names["text"]).where("predicted = 0"), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, with
    all its rows if the id repeats; rows without an id stay."""
    groups = jaccard_join.join(docs.select("doc_id", "text"), width=SHINGLE, percent=PERCENT, links=False)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages by the contamination rule go."""
    apart, names = _apart(docs)
    scanned = decontaminate.judged(decontaminate.scan(apart, table(spark, sf_dir, "benchmark"), text_col=names["text"]))
    return _back(scanned.where(~F.col("contaminated")), names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; every document stays. ``n_chars`` follows the text."""
    apart, names = _apart(docs)
    clean = _back(secret_scan.redact(apart, names["text"]), names)
    if "n_chars" not in docs.columns:
        return clean
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("text").contains(secret_scan.MARK), changed).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The stages hold learned models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # What a stage writes for itself goes when its result stands, and so does the result before.
        with scratch(spark) as keep:
            last, docs = docs, keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        if hasattr(last, "_stored_at"):
            discard(last)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
