"""The corpus pipeline: quality rules, near-duplicate removal, mixing, encoding.

Every stage takes the session, the documents its predecessor left and the folder of the tables, and
returns the documents it leaves; all but the last return the columns of ``documents``. Between stages
the documents are written as Parquet and read again.

* ``quality_rules``: documents that the rules reject go; boilerplate lines go from the others' texts. A
  line in more than ``ENOUGH_TEXTS`` distinct texts of its source is boilerplate however large the source.
* ``near_duplicates``: one document of each group of similar ones (five-word shingles, similarity 0.8
  or more) stays; documents without words all stay.
* ``mixing``: every source weighs the same; documents come as often as their Poisson number says.
* ``encoding``: ids of the whole text with the end id, and whether they decode to the text again.

Nulls, empty tables and clashing columns: as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillview.llm import common, minhash, mixing, quality, sentencepiece_codec

#: 5 % of a source of 2,000 texts: up to there the rules of ``op8_quality_rules`` alone decide.
ENOUGH_TEXTS = 100
#: Words that an encoding worker remembers: idle workers hold them beside the stages of a following run.
REMEMBERED_WORDS = 50_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs, enough=ENOUGH_TEXTS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_duplicates(docs, size=5, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sum"), "text")
    rows = sentencepiece_codec.encode_texts(named, sentencepiece_codec.default_model(), carry=("doc_id", "lang", "source", "sum"), keep=REMEMBERED_WORDS)
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("sum")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The stages hash, sketch and encode in ways that SQL can't state; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stays: list[DataFrame] = []
        # What a stage wrote on its way goes once the documents that it leaves are written.
        with common.scratch(spark, stays):
            docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
            stays.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
