"""One StructType per table. Raw JSON is always read with these, never inferred."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, kind) for name, kind in fields.items()])


S, L, I, B, T = StringType(), LongType(), IntegerType(), BooleanType(), TimestampType()

AUTHOR = _struct(
    id=S, display_name=S, orcid=S, works_count=L, cited_by_count=L,
    last_known_institutions=ArrayType(_struct(display_name=S)),
)

WORK = _struct(
    id=S, display_name=S, publication_year=I, cited_by_count=L, type=S, doi=S,
    open_access=_struct(is_oa=B),
)

PUBLICATION = _struct(
    work_id=S, title=S, university=S, faculty=S, publication_year=I, cited_by_count=L,
    type=S, doi=S, open_access=B, retrieved_at=S,
)

LANDING_SIDECAR = _struct(
    source=S, university=S, faculty=S, data_type=S, crawl_timestamp=S, records_count=L,
)

MANIFEST = _struct(
    source_url=S, university=S, faculty=S, depth_level=I, file_type=S, crawl_timestamp=S,
    content_checksum=S, storage_path=S,
)

PAYLOAD = _struct(
    metadata=_struct(
        source_bucket=S, source_path=S, source_url=S, university=S, faculty=S,
        extraction_type=S, crawl_timestamp=S, extract_timestamp=S, content_checksum=S,
        storage_path=S,
    ),
    text=S,
)

LOG = _struct(timestamp=S, level=S, message=S, university=S, faculty=S, source=S)

LOG_SIDECAR = _struct(object_path=S, source=S, university=S, faculty=S, log_timestamp=S, level=S)

PROFILE = _struct(
    author_id=S, full_name=S, orcid=S, works_count=L, cited_by_count=L, institution_name=S,
    university=S, faculty=S, source_system=S, record_id=S, business_timestamp=T,
    is_deleted=B, language=S,
)

COURSE = _struct(
    course_name=S, raw_filename=S, source_path=S, text_content=S, university=S, faculty=S,
    source_system=S, record_id=S, business_timestamp=T, is_deleted=B, language=S,
)

SEARCH_DOCUMENT = _struct(
    record_id=S, title=S, content=S, university=S, faculty=S, file_type=S, language=S,
    source_url=S, depth_level=I, crawl_timestamp=T, content_checksum=S, storage_path=S,
)

OBJECT = _struct(path=S, length=L, modified=T, university=S, faculty=S)

MARK = _struct(job=S, mark=L)

UNREADABLE = _struct(
    record_id=S, object_path=S, record=S, reason=S, university=S, faculty=S, found_at=T,
)

# Reporting names of the curated tables.
PROFILE_REPORT = _struct(
    record_id=S, name=S, orcid=S, publications_count=L, citations_count=L,
    research_topics=ArrayType(S), university=S, faculty=S, source=S, crawl_timestamp=T,
)

COURSE_REPORT = _struct(
    record_id=S, title=S, level=S, department=S, language=S, raw_content=S, university=S,
    faculty=S, source=S, crawl_timestamp=T,
)


def with_partitions(schema, *names):
    """The schema plus string partition columns, so `month=06` stays "06"."""
    return StructType([*schema.fields, *(StructField(n, S) for n in names)])
