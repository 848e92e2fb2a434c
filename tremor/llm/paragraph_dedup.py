"""Substring deduplication by paragraphs that nearly repeat.

Paragraphs are the lines of a text. Their sets of word shingles are banded by min-max hashing with bands tuned for
high recall, colliding paragraphs are compared by exact Jaccard similarity, and linked ones form components; all
but the first paragraph (by doc_id and place) of a component are removed. See :mod:`tremor.llm.minmax` for how hot
paragraphs are kept from being paired out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, in_chunks, plain, rows_of, ship_by_value
from tremor.llm.minmax import named_texts, near_classes, parts_of, same_row
from tremor.operators.skew import balanced_join
from tremor.workspace import materialise

WORDS, PERCENT = 5, 80
# 24 bands of 3 values: a pair of similarity 0.8 shares none with a chance of 3e-8, one of 0.9 with 2e-14.
BANDS, ROWS = 24, 3
TEXTS = "doc_id long, n_paragraphs long, n_removed long, kept_text string"


def duplicate_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per paragraph that is removed: doc_id, hash (of its text), paragraph (its line from 0), first_id, first_paragraph, members.

    A paragraph needs ``words`` words to be compared. first_id and first_paragraph name the paragraph of its component
    that stays, members is the size of the component. Null and empty texts have no paragraph. A text is known by its
    doc_id and its hash: texts that share an id, null or not, are told apart, and rows that repeat both are treated
    alike. A null doc_id comes before all others, texts of one id in the order of their hashes. An empty table gives no row.
    """
    items, classes = near_classes(plain(docs, id_col, text_col), words, percent, bands, rows, lines=True, least=words)
    repeated = materialise(classes.filter("members > 1"), "paragraph-classes")
    named = balanced_join(items.drop("bands"), repeated, ["set_a", "set_b"], "inner", ["doc_id", "hash", "part"], limit=SMALL_ROWS)
    here = F.struct("doc_id", "hash", "part")
    return named.filter(~here.eqNullSafe(F.col("origin"))).select(
        "doc_id", "hash", F.col("part").alias("paragraph"), F.col("origin.doc_id").alias("first_id"),
        F.col("origin.part").alias("first_paragraph"), "members",
    ).distinct()


def remove_paragraphs(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_removed, kept_text (the other lines), first_ids (sorted documents whose paragraphs it repeats)."""
    listed = materialise(
        removed.groupBy("doc_id", "hash").agg(
            F.collect_list("paragraph").alias("paragraphs"), F.array_sort(F.collect_set("first_id")).alias("first_ids")
        ),
        "paragraphs-removed",
    )
    texts = named_texts(plain(docs, id_col, text_col))
    joined = texts.join(listed, same_row(texts, listed), "left").select(texts["doc_id"], "text", "paragraphs", "first_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for doc_id, text, gone, first_ids in rows_of(batches, "doc_id", "text", "paragraphs", "first_ids"):
                parts = parts_of(text, True)
                drop = set(gone or ())
                kept = "\n".join(p for i, p in enumerate(parts) if i not in drop)
                yield doc_id, len(parts), len(drop), kept, first_ids or []

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        names = ["doc_id", "n_paragraphs", "n_removed", "kept_text", "first_ids"]
        yield from in_chunks(made(), lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names), 500)

    return joined.mapInArrow(run, f"{TEXTS}, first_ids array<long>")


ship_by_value(__name__)
