"""Records that are the same but for white space, case, punctuation or the order of their fields."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.casts import not_blank
from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows
from corpusloom.session import written

# Letters that texts may hold as a base letter with a combining mark, and the one letter they stand for.
COMPOSED = {
    "ç": "ç", "ğ": "ğ", "ş": "ş", "ö": "ö", "ü": "ü", "ä": "ä",
    "â": "â", "î": "î", "û": "û", "é": "é", "è": "è", "á": "á",
}


def small_letters(text: Column) -> Column:
    """``text`` in lower case, in which I, ı, İ and i are one letter, and so are the forms of sigma."""
    low = F.lower(F.replace(text, F.lit("İ"), F.lit("i")))
    return F.replace(F.replace(low, F.lit("ı"), F.lit("i")), F.lit("ς"), F.lit("σ"))


def words(low: Column) -> Column:
    """Letters and digits of a text of ``small_letters``, everything between them as one blank, one blank at
    either end.  Accents are kept, also those written as separate marks; invisible marks fall out."""
    composed = low
    for pair, letter in COMPOSED.items():
        composed = F.replace(composed, F.lit(pair), F.lit(letter))
    composed = F.regexp_replace(composed, r"[\p{Cf}\p{M}]", "")
    clean = F.when(low.rlike(r"[\p{Cf}\p{M}]"), composed).otherwise(low)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(clean, r"[^\p{L}\p{Nd}]+", " ")), F.lit(" "))


@dataclass(frozen=True)
class Record:
    """A nested record as columns: ``fields`` (array of label and value, in any order) and ``body``."""

    fields: Column
    body: Column

    @property
    def digest(self) -> Column:
        """Root digest, bottom up: leaves, then fields, then the unordered header over its sorted children,
        then the ordered pair of header and body."""
        leaf = lambda x: F.sha2(F.concat(F.lit("leaf:"), x), 256)
        field = F.transform(self.fields, lambda f: F.sha2(F.concat(F.lit("field:"), leaf(f["label"]), leaf(f["value"])), 256))
        header = F.sha2(F.concat(F.lit("unordered:"), F.array_join(F.array_sort(field), ",")), 256)
        return F.sha2(F.concat(F.lit("ordered:"), header, leaf(self.body)), 256)

    @property
    def structure(self) -> Column:
        """The record itself with its fields sorted; equal for the same records only."""
        return F.struct(F.array_sort(self.fields).alias("fields"), self.body.alias("body"))


def labelled_records(rows: DataFrame, text: str, labels: Sequence[str], body_label: str) -> DataFrame:
    """``rows`` with the record in a text of labelled fields followed by a labelled body, as the columns
    ``fields`` and ``body`` in place of ``text``.

    ``labels`` are written in small letters.  Labels are found as whole words in whatever layout; what
    stands before the first one is a field without a label, and a text without the body's label is all body.
    """
    compact = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    found = rows.withColumn("_low", small_letters(F.col(text))).drop(text).withColumn("_words", words(F.col("_low"))).drop("_low").withColumn("_at", F.locate(f" {body_label} ", F.col("_words")))
    # Blanks are doubled so that labels next to each other do not share one.
    header = F.replace(F.when(F.col("_at") > 0, F.substring("_words", F.lit(1), F.col("_at"))).otherwise(" "), F.lit(" "), F.lit("  "))
    body = F.when(F.col("_at") > 0, F.substring("_words", F.col("_at") + len(body_label) + 1, F.length("_words"))).otherwise(F.col("_words"))
    found = found.withColumn("_header", F.regexp_replace(header, " (" + "|".join(labels).replace(" ", "  ") + ") ", "\u0001$1\u0002"))
    found = found.withColumn("body", compact(body)).drop("_words", "_at")
    pieces = F.filter(F.split("_header", "\u0001"), lambda x: F.trim(x) != "")
    fields = F.transform(
        pieces,
        lambda x: F.struct(
            F.when(F.contains(x, F.lit("\u0002")), compact(F.substring_index(x, "\u0002", 1))).otherwise("").alias("label"),
            compact(F.substring_index(x, "\u0002", -1)).alias("value"),
        ),
    )
    return found.withColumn("fields", fields).drop("_header")


def record_classes(rows: DataFrame, id_col: str, text_col: str, labels: Sequence[str], body_label: str) -> DataFrame:
    """(keep, id, n_rows): for each id with a text the smallest id that holds the same record, and the
    number of its rows that hold it.

    Texts are parsed into nested records, each gets its root digest, rows are counted by digest and id
    before any shuffle of texts, and only digests with several ids are confirmed: their structures are
    compared in full by grouping on digest and structure, which is combined before the shuffle, so a
    group of copies costs one row for each task that sees it.  Digests shared by different structures
    are told apart by the structure.  Digests of many ids are split wherever ids are joined with them.

    Null ids and null or blank texts are left out; texts without letters and digits are one record.  An id
    delivered with different records belongs to the class of each.  An empty table gives an empty result.
    """
    source = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("id").isNotNull() & not_blank(F.col("text")))
    record = Record(F.col("fields"), F.col("body"))

    def rooted(texts: DataFrame) -> DataFrame:
        return labelled_records(texts, "text", labels, body_label).withColumn("root", record.digest)

    # Written once: a digest is small, and computing it is most of the work.
    ids = written(rooted(source).groupBy("id", "root").agg(F.count("*").alias("n_rows")), "digests")
    sized = ids.groupBy("root").agg(F.count("*").alias("count"), F.min("id").alias("keep"))
    alone = sized.filter("count = 1").select("keep", F.col("keep").alias("id"), "root")
    several = sized.filter("count > 1").select("root")
    hot = hot_keys(sized.select("root", "count"), "root", ids.count())
    spread = split_rows(ids, hot, "root", "id")

    asked = spread.join(repeat_rows(several, hot, "root"), ["root", "part"], "left_semi").select("id").distinct()
    doubtful = source.join(asked, "id", "left_semi")
    shaped = rooted(doubtful).select("id", "root", record.structure.alias("structure"))
    forms = written(shaped.groupBy("root", "structure").agg(F.min("id").alias("keep")), "forms")
    by_root = forms.groupBy("root").agg(F.count("*").alias("forms"), F.min("keep").alias("keep")).join(several, "root", "left_semi")
    same = by_root.filter("forms = 1").select("root", "keep")
    mixed = by_root.filter("forms > 1").select("root")

    copies = spread.join(repeat_rows(same, hot, "root"), ["root", "part"]).select("keep", "id", "n_rows")
    lone = ids.join(alone, ["root", "id"]).select("keep", "id", "n_rows")
    if mixed.isEmpty():
        return lone.unionByName(copies)
    shaped = split_rows(shaped, hot, "root", "id").join(repeat_rows(mixed, hot, "root"), ["root", "part"], "left_semi")
    apart = shaped.groupBy("root", "structure", "id").agg(F.count("*").alias("n_rows")).join(forms, ["root", "structure"]).select("keep", "id", "n_rows")
    return lone.unionByName(copies).unionByName(apart)


def record_counts(classes: DataFrame) -> DataFrame:
    """(keep, n_ids, n_rows): one row for each record, with the number of ids and rows that hold it."""
    return classes.groupBy("keep").agg(F.count("*").alias("n_ids"), F.sum("n_rows").alias("n_rows"))
