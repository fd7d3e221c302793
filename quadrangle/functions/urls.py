"""URL classification, splitting and resolution as Column expressions.

`java.net.URI` refuses many links found in real pages (spaces, pipes, stray
brackets), so splitting uses the lenient RFC 3986 expression instead of
`parse_url`.
"""

from functools import reduce

from pyspark.sql import functions as F

from quadrangle.constants import (
    BUCKETS,
    DEFAULT_BUCKET,
    FILE_TYPE_EXTENSIONS,
    REJECTED_HREF_PREFIXES,
)

_RFC3986 = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
)
_SCHEME, _NETLOC, _PATH, _QUERY, _FRAGMENT = range(1, 6)


def _ending(url):
    """What follows the last dot, query and fragment aside; "" without a dot."""
    bare = F.substring_index(F.substring_index(F.lower(url), "?", 1), "#", 1)
    return F.when(bare.contains("."), F.substring_index(bare, ".", -1)).otherwise("")


def file_type(url):
    """pdf, image, json, document, skip or html, judged by the URL's ending."""
    ending = _ending(url)
    kind = F.when(url.isNull(), F.lit(None))
    for name, endings in FILE_TYPE_EXTENSIONS.items():
        kind = kind.when(ending.isin(endings), name)
    return kind.otherwise("html")


def is_image(url):
    """The URL is of file type image."""
    return _ending(url).isin(FILE_TYPE_EXTENSIONS["image"])


def bucket(kind):
    """Storage bucket of a file type."""
    return reduce(
        lambda chain, pair: chain.when(kind == pair[0], pair[1]),
        BUCKETS.items(),
        F.when(F.lit(False), F.lit(None)),
    ).otherwise(DEFAULT_BUCKET)


def trimmed(url):
    """Without leading blanks and control characters, tabs and line breaks."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def split_parts(url):
    """Struct of scheme, netloc (port kept), path, query and fragment of a trimmed URL."""
    return F.struct(
        F.lower(F.regexp_extract(url, _RFC3986, _SCHEME)).alias("scheme"),
        F.regexp_extract(url, _RFC3986, _NETLOC).alias("netloc"),
        F.regexp_extract(url, _RFC3986, _PATH).alias("path"),
        F.regexp_extract(url, _RFC3986, _QUERY).alias("query"),
        F.regexp_extract(url, _RFC3986, _FRAGMENT).alias("fragment"),
    )


def url_parts(url):
    """Struct of scheme, netloc, path, query and fragment; "" where absent."""
    return split_parts(trimmed(url))


def netloc(url):
    """Host with its port and credentials, as written."""
    return F.regexp_extract(trimmed(url), _RFC3986, _NETLOC)


def staged(array, *steps):
    """Apply steps to array elements, each on the finished result of the one before.

    Written as one expression, every field access would repeat the work behind it.
    """
    for step in steps:
        array = F.transform(array, step)
    return array


def merge_parts(base, ref):
    """Parts of link `ref` seen from page `base` (structs of `url_parts`), dot segments kept.

    Links of another scheme stand on their own; an authority replaces the host;
    an empty path keeps the page's path; other paths are put below the page's folder.
    `settled` says that the path is taken as written.
    """
    foreign = (ref["scheme"] != "") & (ref["scheme"] != base["scheme"])
    own_host = foreign | (ref["netloc"] != "")
    folder = F.when(base["path"] == "", "/").otherwise(F.regexp_replace(base["path"], r"[^/]*\z", ""))
    path = (
        F.when(own_host | ref["path"].startswith("/"), ref["path"])
        .when(ref["path"] == "", base["path"])
        .otherwise(F.regexp_replace(F.concat(folder, ref["path"]), "/{2,}", "/"))
    )
    inherits_query = ~own_host & (ref["path"] == "") & (ref["query"] == "")
    return F.struct(
        F.when(foreign, ref["scheme"]).otherwise(base["scheme"]).alias("scheme"),
        F.when(own_host, ref["netloc"]).otherwise(base["netloc"]).alias("netloc"),
        path.alias("path"),
        F.when(inherits_query, base["query"]).otherwise(ref["query"]).alias("query"),
        ref["fragment"].alias("fragment"),
        (own_host | (ref["path"] == "")).alias("settled"),
    )


def settle_path(parts):
    """Resolve the `.` and `..` segments of merged parts; other paths pass through untouched."""
    path = parts["path"]

    def step(kept, segment):
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    walked = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    # a trailing dot segment names a folder
    folder_mark = F.when(path.rlike(r"/\.\.?\z"), "/").otherwise("")
    rooted = F.concat(F.lit("/"), F.regexp_replace(F.concat(F.array_join(walked, "/"), folder_mark), "^/", ""))
    dotted = ~parts["settled"] & path.contains("/.") & path.rlike(r"/\.\.?(?:/|\z)")
    return parts.withField("path", F.when(dotted, rooted).otherwise(path)).dropFields("settled")


def _tail(mark, part):
    return F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")


def full_url(parts):
    """Parts put back together, fragment included."""
    has_host = parts["netloc"] != ""
    return F.concat(
        parts["scheme"],
        F.when(has_host, "://").otherwise(":"),
        parts["netloc"],
        F.when(has_host & (parts["path"] != "") & ~parts["path"].startswith("/"), "/").otherwise(""),
        parts["path"],
        _tail("?", parts["query"]),
        _tail("#", parts["fragment"]),
    )


def page_url(parts):
    """Parts put back together without fragment and without `;parameters` of the last segment."""
    return F.concat(
        parts["scheme"],
        F.lit("://"),
        parts["netloc"],
        F.regexp_replace(parts["path"], r";[^/]*\z", ""),
        _tail("?", parts["query"]),
    )


def resolve(base_url, href):
    """Absolute form of `href` on the page `base_url`."""
    pair = F.struct(url_parts(base_url).alias("base"), url_parts(href).alias("ref"))
    joined = staged(F.array(pair), lambda p: merge_parts(p["base"], p["ref"]), settle_path, full_url)
    return F.when(href == "", base_url).otherwise(F.get(joined, F.lit(0)))


def followable(href):
    """Neither empty nor an in-page, script, mail or phone link."""
    return (href != "") & ~reduce(
        lambda a, b: a | b, [href.startswith(p) for p in REJECTED_HREF_PREFIXES]
    )
