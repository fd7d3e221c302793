"""Scans of the raw zones: authors, payloads, sidecars, HTML objects, listings."""

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.constants import SIDECAR_SUFFIX
from quadrangle.functions.text import lossy_utf8

_DAY = ("year", "month", "day", "batch")


def _decoded(text):
    """Percent-decoded text; as it is where that is not possible."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def folder_value(path, name):
    """The value in a `name=value` folder, special characters decoded as Spark writes them."""
    return _decoded(F.regexp_extract(path, rf"/{name}=([^/]+)/", 1))


def _scan_path():
    """Path of the object a row was read from."""
    return _decoded(F.col("_metadata.file_path"))


def not_sidecar(name):
    """True for data objects, false for their `.meta.json` companions."""
    return ~name.endswith(SIDECAR_SUFFIX)


_OBJECT = "path string, modificationTime timestamp, length long, content binary"
CORRUPT = "_corrupt_record"


def pair_table(spark, pairs):
    """(university, faculty) pairs, a list of tuples or a table, as a table."""
    if isinstance(pairs, list):
        pairs = spark.createDataFrame(pairs, "university string, faculty string")
    return pairs.select("university", "faculty").distinct()


def relative_path(path):
    """Path of an object within its bucket; as it is where it lies in no university's folder."""
    inside = F.regexp_extract(path, r"(?:\A|/)(university=.*)\z", 1)
    return F.when(inside != "", inside).otherwise(path)


def object_files(spark, root, pairs=None, modified_from=None, modified_to=None):
    """Objects below the root, or of the given (university, faculty) pairs; a pair or root
    that is not stored has none. `modified_from` and `modified_to`, in microseconds, bound
    the time of the last change, both ends included; contents of others stay unread.

    The folders of asked pairs are given to the reader by name, as objects lie at any depth
    in them; there are no more of them than pairs."""
    paths = root
    if pairs is not None:
        stored = stored_partitions(spark, root).join(pair_table(spark, pairs), ["university", "faculty"], "left_semi")
        paths = [row.path for row in stored.select("path").distinct().collect()]
    elif not _exists(spark, root):
        paths = []
    if not paths:
        return spark.createDataFrame([], _OBJECT)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    for bound, test in ((modified_from, ">="), (modified_to, "<=")):
        if bound is not None:
            found = found.where(f"modificationTime {test} timestamp_micros({bound})")
    return found


def _exists(spark, root):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)


def list_objects(spark, root, pairs=None):
    """path within the bucket, length, and the university and faculty in the path; file
    contents stay unread."""
    listed = object_files(spark, root).select(
        relative_path(F.col("path")).alias("path"),
        "length",
        folder_value(F.col("path"), "university").alias("university"),
        folder_value(F.col("path"), "faculty").alias("faculty"),
    ).filter(not_sidecar(F.col("path")))
    return listed if pairs is None else listed.join(pair_table(spark, pairs), ["university", "faculty"], "left_semi")


def stored_partitions(spark, root, subfolder=""):
    """university, faculty and path of the folders below `root`; objects are not listed."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{root}/university=*/faculty=*/{subfolder}")
    folders = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = [(folder.getPath().toString() + "/",) for folder in folders or []]
    return spark.createDataFrame(paths, "path string").select(
        folder_value(F.col("path"), "university").alias("university"),
        folder_value(F.col("path"), "faculty").alias("faculty"),
        "path",
    )


def _json(spark, paths, schema, multi_line, **options):
    """JSON records with `_corrupt_record`, the text of those that could not be read as the
    schema says, and the path of their object; sidecars left out."""
    reader = spark.read.schema(schemas.with_partitions(schema, CORRUPT)).option("multiLine", str(multi_line).lower())
    scan = reader.option("columnNameOfCorruptRecord", CORRUPT).options(**options).json(paths)
    return scan.filter(not_sidecar(F.col("_metadata.file_name"))).withColumn("object_path", relative_path(_scan_path()))


def _is_unread(fields):
    """Nothing of the record could be read."""
    return reduce(and_, [F.col(f).isNull() for f in fields], F.col(CORRUPT).isNotNull())


def readable(scan, fields):
    """Records of which something could be read."""
    return scan.filter(~_is_unread(fields)).drop(CORRUPT, "object_path")


def unreadable(scan, fields):
    """object_path, record, reason, university, faculty: records that could not be read at
    all (`unreadable`), or not in every field (`partly read`; these are data as well)."""
    reason = F.when(_is_unread(fields), "unreadable").otherwise("partly read")
    return scan.filter(F.col(CORRUPT).isNotNull()).select(
        "object_path", F.col(CORRUPT).alias("record"), reason.alias("reason"), "university", "faculty"
    )


def scan_authors(spark, root, pairs=None, multi_line=False, small=False):
    """Author records of every landing day as `_json` gives them; `pairs` prune the folders.
    A list is sent to all tasks, as is a table of pairs known to be `small`."""
    schema = schemas.with_partitions(schemas.AUTHOR, "university", "faculty", *_DAY)
    try:
        scan = _json(spark, f"{root}/university=*/faculty=*/type=authors", schema, multi_line, basePath=root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.with_partitions(schema, "type", CORRUPT, "object_path"))
    if pairs is None:
        return scan
    # the condition lets the planner prune folders by the pairs while the query runs
    wanted = pair_table(spark, pairs).where("university > '' AND faculty > ''")
    if small or isinstance(pairs, list):
        wanted = F.broadcast(wanted)
    return scan.join(wanted, ["university", "faculty"], "left_semi")


def read_authors(spark, root, pairs=None, multi_line=False):
    """Raw authors of every landing day, with university and faculty.

    JSON Lines by default, which Spark can split; `multi_line` reads objects that hold
    one JSON array. Sidecars and empty records give no rows, nor do unreadable ones, which
    `unreadable` shows."""
    scan = scan_authors(spark, root, pairs, multi_line)
    return readable(scan, schemas.AUTHOR.names).dropna("all", subset=schemas.AUTHOR.names)


def scan_payloads(spark, paths, multi_line=False):
    """Payload records anywhere below the given folders, as `_json` gives them."""
    return _json(spark, paths, schemas.PAYLOAD, multi_line, recursiveFileLookup="true").withColumns(
        {n: folder_value(_scan_path(), n) for n in ("university", "faculty")}
    )


def read_payloads(spark, paths, multi_line=False):
    """Extracted-text payloads anywhere below the given folders.

    Other JSON in the same tree (authors, publications) has no `metadata` and stays in
    the result with NULLs, as nothing downstream selects it; sidecars and unreadable
    records do not."""
    return readable(scan_payloads(spark, paths, multi_line), schemas.PAYLOAD.names)


def read_sidecars(spark, root, schema=schemas.MANIFEST):
    """Sidecar metadata with the path, within the bucket, of the object it belongs to."""
    scan = (
        spark.read.schema(schema)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{SIDECAR_SUFFIX}")
        .json(root)
    )
    object_path = F.regexp_replace(relative_path(_scan_path()), r"\.meta\.json\z", "")
    return scan.select(object_path.alias("object_path"), *schema.names)


def read_html_objects(spark, root, pairs=None, modified_from=None, modified_to=None):
    """HTML objects as text, bytes that are not UTF-8 left out; see `object_files`."""
    return (
        object_files(spark, root, pairs, modified_from, modified_to)
        .filter(not_sidecar(F.col("path")))
        .select(
            folder_value(F.col("path"), "university").alias("university"),
            folder_value(F.col("path"), "faculty").alias("faculty"),
            relative_path(F.col("path")).alias("object_name"),
            lossy_utf8(F.col("content")).alias("html"),
        )
    )


def read_stored_pages(spark, root):
    """url, html and crawl_timestamp of stored HTML objects that have a sidecar."""
    described = read_sidecars(spark, root).select(F.col("object_path").alias("object_name"), F.col("source_url").alias("url"), "crawl_timestamp")
    return read_html_objects(spark, root).join(described, "object_name").select("url", "html", "crawl_timestamp")
