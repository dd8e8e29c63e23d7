"""From raw documents to token files, in stages that each apply one operator of ``martlight.llm``.

Every stage takes (spark, docs, folder) and returns the columns of ``documents``; the last returns the directory of
the token files. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.llm import decontaminate, mixing, quality, registry, simhash, tokens
from martlight.llm.common import table
from martlight.session import materialize, work_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The contract of the SimHash operator: words of a shingle, and most differing bits of a link.
SHINGLE, MOST_BITS = 3, 3


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality votes don't reject; the votes are learned on ``docs`` and the table of labels.

    Null and empty texts get the share of label 1 in the sample. Rows that repeat, or whose doc_id is null, are judged
    like others. An empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the smallest doc_id, a null one last.

    Fingerprints are those of shingles of 3 words and link at 3 or fewer differing bits (``simhash``). Of rows that share
    a doc_id the hash of the text and then lang, source and n_chars decide, and rows that agree in all of it are equal, so
    the choice is the same in every run. Rows without an id are grouped like others. ``docs`` is read from Parquet; file
    and row number tell equal rows apart. An empty table gives no rows.
    """
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    rows = docs.select(*COLUMNS, *place)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("text"), "lang", "source", "n_chars", "_file", "_row")
    found = simhash.near_duplicates(rows.select(order.alias("doc_id"), "text"), SHINGLE, MOST_BITS)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id._file", "doc_id._row")
    # As many rows as documents stay, and small when compressed, which Spark would take for a table to broadcast.
    return rows.join(kept.hint("merge"), ["_file", "_row"], "left_semi").select(*COLUMNS)


def without_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that overlap no benchmark item.

    All rows of a doc_id go if one of them overlaps, also those of the null doc_id, since an overlap is known by it. Null
    and empty texts and an empty benchmark leave nothing out. Repeated rows stay repeated; an empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    found = decontaminate.leaks(docs, table(spark, folder, "benchmark")).select(F.col("doc_id").alias("leak")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("leak")), "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, in the order of the mix: the files and the rows in them follow mix_position.

    A null source is a source. Repeated rows and null ids stay; an empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    return mixing.mix(docs, mixing.tempered(docs)).orderBy("mix_position").select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the token files, which keep the order the documents are stored in.

    ``docs`` is read from Parquet; file name and row number give the order the mix has written.
    """
    path = work_path(spark, "tokens")
    placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    tokens.write_tokens(placed, path, registry.tokenizer_path(), registry.END_ID, [F.col("_file"), F.col("_row")])
    return tokens.read_tokens(spark, path)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", without_leaks),
    ("source mix", source_mix),
    ("token files", token_files),
]
#: Votes, SimHash, hash order and token ids have no SQL form; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
