"""From documents to training ids: quality, line dedup, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the documents of the next one. All but the last return
the columns of ``documents``; other columns are dropped, whatever their names.

An empty table gives an empty one. A row without doc_id is never removed by
quality or near dedup. A null text stays null and an empty one empty until the
encoding, where both have no ids; quality keeps them, near dedup counts them as one
group with all texts without words. Rows that repeat a doc_id are judged alike.
Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import kneser_ney, line_join, order_minhash, raking, viterbi_pieces
from larder.llm.common import Stages, read_table
from larder.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    judged = kneser_ney.judge(docs, read_table(spark, sf_dir, "labels"))
    return docs.join(judged.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; ``n_chars`` follows the text."""
    return line_join.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Exact copies come here without a line left, since line dedup keeps the first
    copy of a line only; they are one group. So are all texts without words, null
    ones included. Rows without doc_id stay.
    """
    groups = order_minhash.near_duplicates(docs.select("doc_id", "text"), wordless_alike=True)
    return docs.join(groups.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by their calibrated probability."""
    return raking.mix(docs).where("sampled").select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text that is left."""
    coded = viterbi_pieces.encode(docs, piece_model(), exact="round_trip")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "round_trip", "ids")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL cannot express the quality model, the alignment or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    stages = Stages(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs
