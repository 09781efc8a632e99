"""Cleans and mixes a corpus in five stages; each one calls an operator of kinelake.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. ``docs`` has the columns of
``documents``; rows may repeat and any column may be null. The stages, in order:

1. quality: documents that the factorisation machine scores below ``KEEP`` go (labels are read from ``labels``);
2. near_duplicates: of each group of near-duplicates the row with the smallest id stays (a null id comes last, equal ids by
   text): 5-word shingles, similarity 0.8;
3. repeats: bytes of passages of 200 bytes or more that occurred before are cut out, the first occurrence stays;
4. decontamination: documents that align with a benchmark item go;
5. mixture: documents get copies, so that each source's words come near its target weight; documents without copies go,
   the others come with their text and the number of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.llm import decontam, mixing, quality, setjoin, suffixes
from kinelake.llm.common import small, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP = 0.3


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.learned(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), F.lit(True))
    scored = quality.scored(docs, machine, keep=("text", "lang", "source", "n_chars"))
    return scored.where(F.col("score") >= KEEP).select(*COLUMNS)


def by_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows get a number of their own, written down, so that ids may repeat or be missing
    rows = docs.select(*COLUMNS)
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.coalesce(F.xxhash64("text"), F.lit(0)))
    numbered = written(rows.select(F.monotonically_increasing_id().alias("row"), *COLUMNS), "rows")
    found = setjoin.near_duplicates(numbered, "row", "text", words=5, similarity=0.8, distance=4)
    members = written(numbered.select("row", order.alias("o")).join(found.select(F.col("doc_id").alias("row"), "component_id"), "row"), "members")
    least = members.groupBy("component_id").agg(F.min_by("row", F.struct("o", "row")).alias("row"))
    gone = written(members.select("row").join(least.select("row"), "row", "left_anti"), "copies")
    return numbered.join(small(gone), "row", "left_anti").select(*COLUMNS)


def by_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffixes.without_repeats(docs, keep_first=True, keep=("lang", "source", "n_chars"))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("original"))
    out = kept.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))
    return out


def by_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # equal texts are judged alike, so the text's hash stands for the row: ids may repeat or be missing
    keyed = docs.withColumn("key", F.xxhash64("text"))
    leaked = decontam.contaminated(keyed, table(spark, sf_dir, "benchmark"), doc_id="key").select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(leaked, "key", "left_anti").select(*COLUMNS)


def by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, keep=("text", "lang", "n_chars"))
    return mixed.where("copies > 0").select(*COLUMNS, "size", "copies", "taken", "target")


STAGES = [
    ("quality", by_quality),
    ("near_duplicates", by_near_duplicates),
    ("repeats", by_repeats),
    ("decontamination", by_contamination),
    ("mixture", by_weight),
]

ORACLE_SQL = None  # learned and iterative stages; tests hold each against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
