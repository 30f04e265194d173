"""From raw documents to token files, in five stages of whole tables.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on, with
their columns; its result is written as Parquet and read again before the next.

1. toxicity: documents with a score of 0.7 or more go.
2. near_duplicates: of each group linked by n-gram Jaccard the smallest id stays.
3. decontamination: words of benchmark passages are cut out of the texts.
4. mixing: documents are thinned or repeated until domains have their shares;
   good domains are never thinned.
5. token_ids: binary files of token ids, and a row for each document in them.

Nulls, empty texts, ties and repeated rows: as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from eventloom.llm.common import table, written
from eventloom.llm.queries import word_tokenizer

#: The score from which a document is rejected.
TOXIC_FROM = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = "score" + "_" * max(map(len, docs.columns))
    return toxicity.scored(docs, model, score=score).where(F.col(score) < TOXIC_FROM).drop(score)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = mixing.labelled_by_quality(docs, table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, mixing.WEIGHTS, whole=mixing.WHOLE)


def as_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.encoded(docs, word_tokenizer(), keep_words=False)  # memory of idle workers counts here


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("token_ids", as_token_files),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
SQL: dict[str, str] = {}
