"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all of docs; all but the last keep its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import language, mixing, packing, partenum, secrets
from voxloom.llm.common import Scratch, small

#: Below this mean of each word's highest posterior no language is taken as found.
LEAST_SCORE = 0.4
#: Near duplicates are documents whose five-word shingles have a Jaccard similarity of 0.8 or more.  The narrow band keeps signatures selective, two passes the disk small.
NEAR = {"width": 5, "num": 80, "den": 100, "band": 1.25, "weak": 1, "passes": 2}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is found; those without a letter, without a text or of no clear language go.  Where no label could be learned from, all documents with a letter stay."""
    model = language.train(*language.labelled_sample(docs))
    found = language.identify(docs, model)
    if model.labels == [language.UNKNOWN]:
        return found.where("n_words > 0").select(*docs.columns)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("certainty") >= LEAST_SCORE)).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document of the smallest doc_id, once; rows with a null doc_id link with nothing and stay."""
    scratch = Scratch(spark, "jaccard")
    found = scratch.keep(partenum.near_duplicates(docs, **NEAR).where("doc_id != component_id").select("doc_id").distinct())
    kept = docs.join(small(found, found.count()), "doc_id", "left_anti")
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
    return kept.select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; no document goes."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights of their sources, in shuffled order."""
    return mixing.mix(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the pieces of all documents into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]
