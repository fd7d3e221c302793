"""Ordered text assembly."""

from pyspark.sql import functions as F

from quadrangle.functions.text import strip


RANGE = 1024


def join_pages(pages, keys, page_no="page_no", text="text", span=RANGE):
    """Non-empty page texts in page order, one per line, edge whitespace removed.

    Pages are joined within ranges of `span` page numbers first, then the ranges of a
    document, so that no task sorts the pages of a whole long document. Returns `keys` and
    text, one row per document: a document is one string by definition, and one that no
    string can hold fails the job rather than losing pages.
    """
    spoken = F.when(F.col(text) != "", F.col(text))
    numbered = pages.select(*keys, F.col(page_no).alias("_page"), spoken.alias("_text"))
    ranges = (
        numbered.withColumn("_range", F.floor(F.col("_page") / span))
        .groupBy(*keys, "_range")
        .agg(F.expr(r"listagg(_text, '\n') WITHIN GROUP (ORDER BY _page)").alias("_text"))
    )
    return (
        ranges.groupBy(*keys)
        .agg(F.expr(r"listagg(_text, '\n') WITHIN GROUP (ORDER BY _range)").alias("text"))
        .withColumn("text", F.coalesce(strip(F.col("text")), F.lit("")))
    )
