"""MinHash near-deduplication of documents with min-max hashing; see :mod:`tremor.llm.minmax`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, plain
from tremor.llm.minmax import near_classes, same_row, with_class
from tremor.operators.skew import is_small
from tremor.workspace import materialise

# 32 bands of 4 values: a pair of similarity 0.8 shares no band with a chance of 5e-8.
BANDS, ROWS = 32, 4


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |A and B| >= percent * |A or B| over their sets of ``words``-word shingles (A-Z
    in lower case, words ended by ASCII white space; a shorter text is one shingle). component_id is the smallest
    doc_id reachable, and kept is doc_id = component_id. Null, empty and blank texts have no shingles and are
    linked with nothing. A null doc_id is smaller than all others and counts as an id like them; kept goes by ids
    alone, so texts that share the id of their component are all kept here. An empty table gives no row; other columns are not read.
    """
    return _marked(docs, id_col, text_col, words, percent, bands, rows).drop("hash", "stays")


def _marked(
    docs: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """:func:`near_duplicates` with the row's hash and ``stays``: whether it is the row, by id and text, that represents its component."""
    items, classes = near_classes(plain(docs, id_col, text_col), words, percent, bands, rows)
    named = with_class(items, classes)
    filled = F.col("n_shingles") > 0
    component = F.when(filled, F.col("origin.doc_id")).otherwise(F.col("doc_id"))
    first = F.col("doc_id").eqNullSafe(F.col("origin.doc_id")) & (F.col("hash") == F.col("origin.hash"))
    return named.select(
        "doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "hash", (~filled | first).alias("stays"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns.

    A row is known by its id and its text: of rows that share an id, null or not, only the one that represents its
    component stays (and those that repeat it in both). Texts without words stay.
    """
    gone = _marked(docs, id_col, text_col, **settings).filter(~F.col("stays")).select("doc_id", "hash").distinct()
    gone = materialise(gone, "near-dropped")
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"))
    right = F.broadcast(gone) if is_small(gone, SMALL_ROWS) else gone
    return marked.join(right, same_row(marked, gone), "left_anti").select("_doc.*")
