"""Text, key, time and JSON expressions."""

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import functions as F

from quadrangle.constants import DYNAMIC_MARKERS

_BLANK = r"[\s\x1c-\x1f]"


def any_of(tests):
    """OR of boolean columns."""
    return reduce(lambda a, b: a | b, tests)


def strip(text):
    """Remove edge whitespace of every kind, not only spaces."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}++|(?<!{_BLANK}){_BLANK}++\z", "")


def slug(name):
    """Lower case with spaces as underscores."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def record_key(*parts):
    """MD5 over the parts joined by underscores; NULL parts are left out."""
    return F.md5(F.concat_ws("_", *parts))


def short_checksum(text):
    """First eight hex digits of the MD5."""
    return F.substring(F.md5(text), 1, 8)


def last_segment(url):
    """What follows the last slash of an identifier URL."""
    return F.element_at(F.split(url, "/"), -1)


def text_or_empty(column):
    return F.coalesce(column, F.lit(""))


def lossy_utf8(raw):
    """Decode bytes as UTF-8, leaving out whatever is not valid.

    A replacement character that the bytes really contain is kept: it is spelled with a
    mark while the invalid bytes are replaced and removed. Marks that the text already
    holds are spelled out first, so that nothing is mistaken for one.
    """
    bad, mark = F.lit("�"), "\uFDD0"
    text = raw.cast("string")
    marked = F.replace(F.replace(text, F.lit(mark), F.lit(mark + "0")), bad, F.lit(mark + "1"))
    cleaned = F.replace(F.make_valid_utf8(marked), bad, F.lit(""))
    spelled = F.replace(F.replace(cleaned, F.lit(mark + "1"), bad), F.lit(mark + "0"), F.lit(mark))
    return F.when(F.is_valid_utf8(text), text).otherwise(spelled)


def iso_timestamp(ts):
    """ISO-8601 with microseconds, which are left out when zero."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
    )


def clock_timestamp(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def compact_timestamp(ts):
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def day_path(ts):
    """`year=…/month=…/day=…` with zero-padded month and day."""
    return F.date_format(ts, "'year='yyyy'/month='MM'/day='dd")


def json_object(**fields):
    """One flat JSON object with `, ` and `: ` separators; NULLs are written as null."""

    def quoted(value):
        array = F.to_json(F.array(value), {"ignoreNullFields": "false"})
        return F.substr(array, F.lit(2), F.length(array) - 2)

    members = [F.concat(F.lit(f'"{name}": '), quoted(value)) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def json_extension(path):
    """Object path of the extracted text: every document ending becomes `.json`."""
    for ending in (".pdf", ".docx", ".doc"):
        path = F.replace(path, F.lit(ending), F.lit(".json"))
    return path


def looks_dynamic(html):
    """The page carries a marker of client-side rendering."""
    return any_of([html.contains(marker) for marker in DYNAMIC_MARKERS])


def _numeric_references(pattern, base):
    def put(done, reference):
        digits = F.regexp_extract(reference, pattern, 1)
        code = F.lpad(F.conv(F.when(F.length(digits) < 8, digits), base, 16), 8, "0")
        none = code.isNull() | code.rlike("^0000D[89A-F]") | (code > "0010FFFF")
        char = F.when(none, "�").otherwise(F.decode(F.unhex(F.when(~none, code)), "UTF-32"))
        return F.replace(done, reference, char)

    def decode(text):
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        return F.when(text.contains("&#"), F.aggregate(found, text, put)).otherwise(text)

    return decode


# the names HTML defines, as the standard library lists them; ampersands come last
NAMED_REFERENCES = {name[:-1]: char for name, char in html5.items() if name.endswith(";") and char != "&"}


def _named_references(text):
    """Replace `&name;` of every name that HTML defines; unknown names stay."""
    table = F.from_json(F.lit(json.dumps(NAMED_REFERENCES)), "map<string,string>")
    pattern = "&([A-Za-z][A-Za-z0-9]*);"
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))

    def put(done, name):
        written = F.concat(F.lit("&"), name, F.lit(";"))
        return F.replace(done, written, F.coalesce(F.try_element_at(table, name), written))

    named = F.when(text.rlike(pattern), F.aggregate(found, text, put)).otherwise(text)
    return F.replace(F.replace(named, F.lit("&AMP;"), F.lit("&")), F.lit("&amp;"), F.lit("&"))


# Steps that replace character references in attribute values: numeric ones, and names.
# A numeric ampersand is spelled out first, so that it starts no new reference.
UNESCAPE_STEPS = (
    lambda text: F.when(
        text.contains("&#"), F.regexp_replace(text, r"&#(?:0*38|[xX]0*26);", "&amp;")
    ).otherwise(text),
    _numeric_references(r"&#0*([1-9][0-9]*);", 10),
    _numeric_references(r"&#[xX]0*([1-9a-fA-F][0-9a-fA-F]*);", 16),
    _named_references,
)
