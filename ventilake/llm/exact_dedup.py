"""Exact duplicates after deleting white space, combined in skew-safe steps.

Rows are grouped by (digest, whole text, salt): Spark's partial aggregation
removes copies inside each input partition, the shuffle merges what is left of
each salted digest group, and a second grouping by (digest, whole text)
combines the winners of the salts.  Every step compares the text itself, the
digest only spreads the rows; a group of any size reaches the last step as at
most ``salts`` rows.

Defined cases: null text counts as empty and all empty texts are copies of each
other; of equal lengths the smallest id stays; a null id ranks behind all
others, so ``keep_id`` is null only where a group has no other id; rows that
repeat an id count one by one and share the fate of that id (the filter
``drop_exact_copies`` keeps one row of a group); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import ASCII_SPACE, checkpointed, fresh, id_text

SALTS = 32
_TOP = 2**63 - 1
_SPAN = Decimal(2**64)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def squeezed(text: Column) -> Column:
    return F.translate(text, ASCII_SPACE, "")


def _rank(doc_id: Column, text: Column) -> Column:
    """Longest first, then smallest id, as one number (primitive, so hash aggregation applies)."""
    low = F.lit(Decimal(_TOP)) - F.coalesce(doc_id, F.lit(_TOP)).cast("decimal(20,0)")
    return (F.length(text).cast("decimal(10,0)") * F.lit(_SPAN) + low).cast("decimal(38,0)")


def _winner(rank: Column) -> Column:
    kept = (F.lit(Decimal(_TOP)) - rank % F.lit(_SPAN)).cast("long")
    return F.when(kept != F.lit(_TOP), kept)


def groups(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    """One row per distinct text: ``digest``, ``norm``, ``rank`` (of the row that stays), ``keep_id``, ``group_size``."""
    rows = id_text(docs, id_col, text_col).select(
        squeezed(F.col("text")).alias("norm"),
        _rank(F.col("doc_id"), F.col("text")).alias("rank"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    rows = rows.select("norm", digest(F.col("norm")).alias("digest"), "rank", "salt")
    salted = rows.groupBy("digest", "norm", "salt").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    return (
        salted.groupBy("digest", "norm")
        .agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))
        .select("digest", "norm", "rank", _winner(F.col("rank")).alias("keep_id"), "group_size")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``.

    Rows find their group by digest.  Where two different texts were found
    under one digest (possible only with a weaker ``digest`` than the default)
    they find it by digest and text instead."""
    found = groups(docs, id_col, text_col, salts, digest)
    small = checkpointed(found.drop("norm", "rank"))
    rows = id_text(docs, id_col, text_col).select("doc_id", squeezed(F.col("text")).alias("norm"))
    rows = rows.select("doc_id", "norm", digest(F.col("norm")).alias("digest"))
    if small.groupBy("digest").count().where("count > 1").isEmpty():
        joined = rows.drop("norm").join(small, "digest")
    else:
        joined = rows.join(found, ["digest", "norm"]).drop("norm")
    return joined.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay.

    The row that stays has the longest text and of these the smallest id (a null
    id last).  Rows are told apart by digest and rank, not by id: of repeated rows
    one stays, and rows with one id and different texts are judged one by one (those
    whose texts differ in white space alone and are equally long count as repeated)."""
    digest, rank = fresh(docs, "text_digest", "text_rank")
    best = groups(docs, id_col, text_col, SALTS, sha256).select(F.col("digest").alias(digest), F.col("rank").alias(rank))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumns({digest: sha256(squeezed(text)), rank: _rank(F.col(id_col).cast("long"), text)})
    # copies in one input partition are dropped before the shuffle
    rows = rows.dropDuplicates([digest, rank])
    return rows.join(best, [digest, rank], "left_semi").select(*docs.columns)
