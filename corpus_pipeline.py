"""From documents to shards: toxic ones out, one of each near-duplicate group, no
benchmark text, sources mixed to target weights, and shards of near equal size.

``run`` applies the stages to the ``documents`` of a folder. Each stage's result is
written to the shared scratch folder and read back as the next one's documents, so a
lost executor costs at most a stage.

All stages take documents of any kind: null or empty texts, languages and sources, texts of
any length (always read whole), repeated rows, rows with equal ids, and columns beside those
of documents, which all stages hand on. An empty table stays empty through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from logweir.llm.frames import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near-duplicates: words in a shingle, and percent of shingles in common.
SHINGLE, SIMILAR = 5, 80
#: Target weights of sources; all others have weight 1.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
SHARDS = 24


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.

    Null and empty texts have no evidence and the score of the share of toxic labels. Where
    no label is of a document, all scores are 0 and all documents stay. Repeated rows are
    scored alike.
    """
    scored = toxicity.toxicity(docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id.

    Of equal ids the row with the least text hash stays, nulls come last, and of rows
    repeated as a whole one stays. Rows without words are in no group and all stay.
    """
    return ngram_join.one_of_each(docs, SHINGLE, SIMILAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are words of the benchmark.

    A document of which exactly a twentieth are goes. Without words nothing is found, and an
    empty benchmark finds nothing. Repeated rows are judged alike.
    """
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.is_contaminated()).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled.

    Null is a source of its own. Sources without any text stay out, since no number of
    repetitions reaches a weight; of others, rows with empty texts are repeated like the
    rest. Rows with equal ids are repeated equally often.
    """
    return mixing.mixed(docs, WEIGHTS).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it.

    Equal texts (null: empty) are in one shard; repeated rows have slots of their own, in an
    order that nothing depends on. Columns ``shard`` and ``slot`` that documents have are
    replaced.
    """
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in {"shard", "slot"}]
    return sharding.shard_by_size(docs, SHARDS).select(*kept, "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Models and components of links are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        del name
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
