"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next one's ``docs``; all but the last keep the columns of ``documents``.

Defined cases: empty tables pass through; null texts are rejected by the first stage.  The two
stages that filter by other documents number the rows and decide row by row, so rows without
``doc_id`` or with a shared one are treated like all others.  The id only says which row of a group
stays: a missing one counts as larger than all others, and of equal ones the row whose other columns
have the smallest hash stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftwell.llm import contamination, language, packing, recompression, simhash
from driftwell.llm.common import ship_package, staged, table
from driftwell.llm.queries import tokenizer_path
from driftwell.session import delete_path, scratch_path
from driftwell.sources.writers import stage

# A document's main language makes up at least this share of it.
LEAST_SHARE = 0.3


def language_id(
    spark: SparkSession,
    docs: DataFrame,
    sf_dir: str,
    *,
    languages: Sequence[str] | None = None,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Documents whose main language is known and makes up enough of them.

    The model decides: a document goes if its main language has less than ``least_share`` of it, or
    is not among ``languages`` (all that were learned, if not given).  Where ``lang`` is null the main
    language is written into it.  Null texts and texts without a letter go; where there is no row to
    learn languages from, only those do.
    """
    model = language.learn_from(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # The document travels as one column, so that none of its own can clash with what is found.
    found = docs.select(F.struct("*").alias("doc"), language.detect_column(model, F.col("text")).alias("found"))
    main = F.col("found.lang_pred")
    kept = found.where((main != language.UNKNOWN) & (F.col("found.score") >= least_share))
    if languages is not None:
        kept = kept.where(main.isin(*languages))
    columns = [F.coalesce(F.col("doc")[c], main) if c == "lang" else F.col("doc")[c] for c in docs.columns]
    return kept.select(*[column.alias(c) for column, c in zip(columns, docs.columns)])


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """``row, doc``: a number for each row and the row, staged, since every reading must give the same numbers."""
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), label)


def _texts(numbered: DataFrame) -> DataFrame:
    return numbered.select("row", F.col("doc")["text"].alias("text"))


def _kept(numbered: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    return numbered.join(rows, "row", how).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id."""
    numbered = _numbered(docs, "near-duplicates")
    groups = simhash.simhash_duplicates(_texts(numbered), id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    doc = F.col("doc")
    others = F.xxhash64(*[doc[c] for c in docs.columns if c != "doc_id"])
    order = F.struct(doc["doc_id"].isNull().alias("missing"), doc["doc_id"].alias("id"), others.alias("hash"), "row")
    ordered = numbered.select("row", order.alias("order")).join(groups, "row")
    first = ordered.groupBy("component_id").agg(F.min("order").alias("order")).select("order.row")
    return _kept(numbered, first, "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that stand elsewhere too."""
    return recompression.without_repeated_words(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    numbered = _numbered(docs, "decontamination")
    leaks = contamination.find_contamination(_texts(numbered), table(spark, sf_dir, "benchmark"), id_col="row")
    return _kept(numbered, leaks.select(F.col("doc_id").alias("row")).distinct(), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of fixed length."""
    pieces = packing.pack_documents(docs, tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Fingerprints (XXH64), EM and tokenising can not be said in SQL; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the last one's frame is read from what was written."""
    ship_package(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = stage(step(spark, docs, sf_dir), path)
        # What the step has read is no longer needed.
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
