"""Stored pages -> link reach, manifest and counters of each crawl."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import FILE_TYPE_EXTENSIONS, MAX_CRAWL_DEPTH
from quadrangle.functions.text import day_path, iso_timestamp
from quadrangle.functions.urls import bucket, file_type, netloc
from quadrangle.operators.latest import first_per_key
from quadrangle.operators.links import allowed_link, with_links
from quadrangle.operators.reach import reach
from quadrangle.session import cut
from quadrangle.operators.upsert import upsert

CRAWL = ["university", "faculty"]


def classified(urls):
    """URLs with their file type and bucket."""
    kind = file_type(F.col("url"))
    return urls.withColumn("file_type", kind).withColumn("bucket", bucket(F.col("file_type")))


def content_checksum(content):
    """MD5 of the whole content; NULL where nothing was fetched."""
    return F.when(F.length(content) > 0, F.md5(content))


def manifest(fetched, run_ts):
    """One row per fetched object.

    `fetched`: url, university, faculty, depth, content_checksum. Assets that are never
    stored and objects without content give no row.
    """
    stored = classified(fetched).filter(
        (F.col("file_type") != "skip") & F.col("content_checksum").isNotNull()
    )
    object_path = F.concat(
        F.lit("university="), "university", F.lit("/faculty="), "faculty", F.lit("/"),
        day_path(run_ts), F.lit("/"), F.md5("url"), F.lit("."), "file_type",
    )
    return stored.select(
        F.col("url").alias("source_url"),
        "university",
        "faculty",
        F.col("depth").cast("int").alias("depth_level"),
        "file_type",
        iso_timestamp(run_ts).alias("crawl_timestamp"),
        "content_checksum",
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), object_path).alias("storage_path"),
    ).select(*schemas.MANIFEST.names)


def crawl_counts(fetched):
    """Per crawl: objects by file type, errors (nothing fetched) and URLs visited."""
    kind, has_content = F.col("file_type"), F.col("content_checksum").isNotNull()
    stored_kinds = ["html", *[k for k in FILE_TYPE_EXTENSIONS if k != "skip"]]
    return classified(fetched).groupBy(*CRAWL).agg(
        *[F.count_if((kind == k) & has_content).alias(k) for k in stored_kinds],
        F.count_if(kind == "skip").alias("skip"),
        F.count_if((kind != "skip") & ~has_content).alias("errors"),
        F.count(F.lit(1)).alias("visited"),
    )


def described_pages(pages):
    """Per stored page its checksum and links, from one pass over the contents.

    Later steps work on this table; contents are neither read again nor shuffled.
    """
    markup = F.when(file_type(F.col("url")) == "html", F.col("html")).otherwise("")
    checksum = content_checksum(F.col("html")).alias("content_checksum")
    return cut(with_links(pages.select("url", checksum, markup.alias("html")), keep=["url", "content_checksum"]))


def visited_urls(described, seeds, max_depth=MAX_CRAWL_DEPTH):
    """Every URL a crawl visits, with its depth.

    `described`: url, links. `seeds`: university, faculty, url. All crawls walk
    together, each within the domain of its own seed.
    """
    links = described.select(F.col("url").alias("src"), F.explode("links").alias("to")).select(
        "src", F.col("to.link").alias("dst"), "to.netloc", "to.is_image"
    )
    starts = seeds.withColumn("allowed", netloc(F.col("url")))
    return reach(
        links, starts, groups=[*CRAWL, "allowed"], max_depth=max_depth, follow=allowed_link(F.col("allowed"))
    ).drop("allowed")


def fetched_objects(pages, seeds, max_depth=MAX_CRAWL_DEPTH):
    """Visited URLs with the checksum of the stored content, NULL where nothing is stored.

    `pages`: url (unique), html.
    """
    described = described_pages(pages)
    checksums = described.select("url", "content_checksum")
    return visited_urls(described, seeds, max_depth).join(checksums, "url", "left")


def store_manifest(rows, path):
    """Keep the newest manifest row of every stored object; a crawl run again replaces its rows."""
    return upsert(rows, path, keys=("storage_path",), order="crawl_timestamp")


def newest_pages(stored):
    """url, html: the newest copy of every page, of rows that also have crawl_timestamp."""
    checksum = F.md5("html")
    return first_per_key(stored, ["url"], [F.desc_nulls_last("crawl_timestamp"), checksum.asc_nulls_last()]).select("url", "html")


def run(pages, seeds, manifest_path, run_ts, max_depth=MAX_CRAWL_DEPTH):
    """Walk, put the manifest, return the counters per crawl. `pages`: url (unique), html;
    `newest_pages` makes such a table of pages stored day by day."""
    fetched = cut(fetched_objects(pages, seeds, max_depth))
    store_manifest(manifest(fetched, run_ts), manifest_path)
    return crawl_counts(fetched)
