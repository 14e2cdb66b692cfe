"""A corpus from documents: judge, de-duplicate, decontaminate, pack. Each stage works on all that the one before kept."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.llm import curve_packing, leaks, quality_votes, repeats, similar
from depthmill.llm.queries import WORD_BPE
from depthmill.session import written


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and all columns but the text as one, so that no column of the documents meets one that a stage adds."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("own"))


def _restored(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    return rows.select(*[(changed[c] if c in changed else F.col("text") if c == "text" else F.col("own")[c]).alias(c) for c in columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are.

    Null, empty and very short texts are rejected; long ones are judged whole. Each row is judged by itself, repeated or not, with
    or without an id; the rules' weights come from all rows. An empty table stays empty. Columns of any name are kept.
    """
    return _restored(quality_votes.judged(_carried(docs)).where("kept"), docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of five-word shingles in common), the one with the smallest id.

    Texts without words (null, empty) are copies of each other; shorter texts than five words are one shingle. Of rows that
    repeat an id each belongs to its own text's group; of equal rows one stays. Rows without an id stay, all of them. Texts of any
    length are compared whole. An empty table stays empty. Columns of any name are kept.
    """
    return similar.keep_first(docs, size=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words that occur more than once; n_chars, where there is one, follows the text.

    A null text stays null (its n_chars too), an empty one empty; texts of any length are looked at whole. Repeated rows are
    occurrences of each other and lose what they share, whatever their ids. An empty table stays empty. Columns of any name are kept.
    """
    return _restored(repeats.without_repeats(_carried(docs)), docs.columns, n_chars=F.length("text").cast("long"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim passage of the benchmark: ten words of an item, or all words of a shorter one.

    Null and empty texts hold none and stay; so do all documents if the benchmark is empty. Texts of any length are searched whole.
    Each row is judged by itself, repeated or not, with or without an id. An empty table stays empty. Columns of any name are kept.
    """
    return _restored(leaks.decontaminated(_carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with a checksum of their ids in place of the ids.

    A null or empty text is its end id alone; a long one is cut into as many pieces as it takes. Repeated rows and rows without an id are
    packed like any other. An empty table gives no pieces. Only doc_id and text are read.
    """
    pieces = curve_packing.packed(docs.select("doc_id", "text"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_votes", keep_good),
    ("near_copies", keep_distinct),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("curve_packing", pack),
]

#: Fingerprints, token ids and EM can't be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over `documents`; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
