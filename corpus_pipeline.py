"""The training-data pipeline over ``documents``: five stages, each one operator.

A stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read
again as the documents of the next stage. All stages but the last return the columns of
``documents``; the last returns packed pieces with their token ids.

1. Documents that the quality ranking rejects go.
2. Lines that repeat an earlier run of lines are cut out of the texts.
3. Of each group of near copies the document with the smallest id stays. Two texts are linked if their
   SimHash fingerprints lie within the radius (the operator of ``op3``), or if the Jaccard similarity of
   their five-word shingles is at least 0.8, which the radius alone misses; a group is what links of
   either kind connect. Texts that the stage before has emptied are one group.
4. Documents that hold an item of ``benchmark`` go.
5. The texts are tokenized and packed into sequences.

Null texts and repeated rows are treated as the operators say; an empty table passes
through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import decontaminate, lines, nearcopies, packing, quality, simhash
from riskflow.llm.common import table
from riskflow.llm.tokens import path
from riskflow.sources.tables import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeats(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.one_of_each(docs, more=simhash.text_links)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, path(packing.VOCABULARY), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: XXH64 and the ranking cannot be expressed in SQL; tests compare with plain versions.
ORACLE_SQL = None
