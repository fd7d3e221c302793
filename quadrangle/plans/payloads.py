"""Documents with page texts, and their sidecars -> text payloads."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import DOCUMENT_BUCKET, EXTRACTION_TYPE, TEXT_BUCKET
from quadrangle.functions.text import iso_timestamp, json_extension, text_or_empty
from quadrangle.operators.concat import join_pages
from quadrangle.operators.latest import first_per_key
from quadrangle.session import cut
from quadrangle.sinks.files import land_json
from quadrangle.sources.raw import not_sidecar


def document_kind(path):
    """pdf or docx by the path's ending; NULL for objects that are not extracted."""
    return F.when(path.endswith(".pdf"), "pdf").when(
        path.endswith(".docx") | path.endswith(".doc"), "docx"
    )


def payloads(documents, sidecars, run_ts):
    """One payload per document with text.

    `documents`: path, text. `sidecars`: object_path and the manifest fields; a document
    without one gets empty metadata.
    """
    path = F.col("path")
    target = json_extension(path)
    worded = documents.filter(
        not_sidecar(path) & document_kind(path).isNotNull() & (F.length("text") > 0)
    )
    described = worded.join(
        sidecars.select(
            F.col("object_path").alias("path"), "source_url", "university", "faculty", "crawl_timestamp"
        ),
        "path",
        "left",
    )
    metadata = F.struct(
        F.lit(DOCUMENT_BUCKET).alias("source_bucket"),
        path.alias("source_path"),
        *[text_or_empty(F.col(name)).alias(name) for name in ("source_url", "university", "faculty")],
        F.lit(EXTRACTION_TYPE).alias("extraction_type"),
        text_or_empty(F.col("crawl_timestamp")).alias("crawl_timestamp"),
        iso_timestamp(run_ts).alias("extract_timestamp"),
        F.md5("text").alias("content_checksum"),
        F.concat(F.lit(f"s3://{TEXT_BUCKET}/"), target).alias("storage_path"),
    )
    return described.select(metadata.alias("metadata"), "text")


def extraction_counts(documents):
    """pdf, docx, skipped and errors.

    `documents`: path, n_chars; a NULL length stands for an object that failed to read.
    """
    path, kind = F.col("path"), document_kind(F.col("path"))
    failed = F.col("n_chars").isNull()
    worded = F.col("n_chars") > 0
    return documents.filter(not_sidecar(path)).agg(
        F.count_if((kind == "pdf") & worded).alias("pdf"),
        F.count_if((kind == "docx") & worded).alias("docx"),
        F.count_if(~failed & (kind.isNull() | ~worded)).alias("skipped"),
        F.count_if(failed).alias("errors"),
    )


def write(payload_rows, root):
    """Land payloads below the university and faculty folders of their source path, and a
    batch folder named from the time of extraction.

    Writing a batch again replaces it; `newest` picks among the batches."""
    source = F.col("metadata.source_path")
    folders = {
        name: F.regexp_extract(source, rf"(?:^|/){name}=([^/]+)/", 1) for name in ("university", "faculty")
    }
    stamp = F.regexp_replace("metadata.extract_timestamp", "[^0-9]", "")
    folders["batch"] = F.concat(F.substring(stamp, 1, 8), F.lit("_"), F.substring(stamp, 9, 12))
    land_json(payload_rows, schemas.PAYLOAD.names, folders, root)


def newest(payload_rows):
    """The latest extraction of every source object."""
    order = [F.desc_nulls_last("metadata.extract_timestamp"), F.asc_nulls_last("metadata.content_checksum")]
    return first_per_key(payload_rows, ["metadata.source_path"], order)


def run(page_texts, sidecars, root, run_ts):
    """Join page texts per document, build the payloads, land them; returns the counts.

    `page_texts`: path, page_no, text. Texts are assembled once; the counts read only
    paths and lengths of the assembled table.
    """
    documents = cut(join_pages(page_texts, ["path"]).withColumn("n_chars", F.length("text")))
    write(payloads(documents, sidecars, run_ts), root)
    return extraction_counts(documents)
