"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.casts import not_blank as not_blank

# Prefixes of the roles of a text, and column names in order of preference.
ROLES = {"query": "query: ", "passage": "passage: "}
TEXT_COLUMNS = ("mdtext", "text", "text_snippet", "content", "chunk_text", "body")
ID_COLUMNS = ("doc_id", "documentid", "document_id", "docid")


def preview(col: Column, limit: int = 200) -> Column:
    """The first ``limit`` characters, and ``...`` if there are more."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit("..."))).otherwise(col)


def shortened(col: Column, limit: int = 50) -> Column:
    """At most ``limit`` characters, the last three ``...`` if some are missing."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)


def with_role(col: Column, role: str = "query") -> Column:
    return F.concat(F.lit(ROLES[role]), F.coalesce(col, F.lit("")))


def millions_label(col: Column) -> Column:
    """``0m``, ``1m``, ``6.6m``: millions with at most one decimal."""
    return F.concat(F.regexp_replace(F.format_string("%.1f", col / F.lit(1_000_000.0)), r"\.0$", ""), F.lit("m"))


def text_column(columns: list[str]) -> str:
    """The first of TEXT_COLUMNS there is, else the first column."""
    return next((c for c in TEXT_COLUMNS if c in columns), columns[0])


def id_column(columns: list[str]) -> str | None:
    """The first of ID_COLUMNS there is, else none."""
    return next((c for c in ID_COLUMNS if c in columns), None)
