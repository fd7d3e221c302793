"""Links of HTML pages.

A page's links are found, resolved and made distinct inside its own row, so link
extraction needs no shuffle however many links there are.
"""

from pyspark.sql import functions as F

from quadrangle.functions.text import UNESCAPE_STEPS
from quadrangle.functions.urls import (
    followable,
    full_url,
    is_image,
    merge_parts,
    page_url,
    settle_path,
    split_parts,
    staged,
    trimmed,
)

# Possessive quantifiers keep the matcher iterative on long tags. Quotes count only after
# an equals sign; quoted text is stepped over as a whole, so a `>` or a look-alike
# attribute inside it is not taken for the real thing.
_INERT = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b.*?(?:</script\s*>|\z)"
    r"|<style\b.*?(?:</style\s*>|\z)"
)
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_TAG = rf"""(?i)<((?:a|img)(?=[\s/])(?:[^>=]++|=\s*+(?:{_QUOTED}|(?!["'])[^\s>]*+))*+)>"""


def _written(tag, attribute):
    """The value of an attribute as written, quotes included; the last one counts."""
    pattern = rf"""(?is)(?<=[\s"'/]){attribute}\s*+=\s*+({_QUOTED}|[^\s"'>][^\s>]*+)|=\s*+{_QUOTED}"""
    values = F.regexp_extract_all(tag, F.lit(pattern), F.lit(1))
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v != ""), F.lit(-1)), F.lit(""))


def _reference(tag):
    """Where an `a` or `img` tag points to, "" for nowhere."""
    on_image = F.lower(F.substring(tag, 1, 3)) == "img"
    written = F.when(on_image, _written(tag, "src")).otherwise(_written(tag, "href"))
    return F.struct(on_image.alias("on_image"), written.alias("to"))


def _step(change):
    """A step that changes the reference and remembers the kind of tag."""
    return lambda r: F.struct(r["on_image"].alias("on_image"), change(r["to"]).alias("to"))


def _unquoted(value):
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1\z""", "$2")


def _finished(r):
    """Anchors lose their fragment, images keep it."""
    to = r["to"]
    return F.struct(
        r["on_image"].alias("on_image"),
        F.when(r["on_image"], full_url(to)).otherwise(page_url(to)).alias("link"),
        to["netloc"].alias("netloc"),
        is_image(F.concat(to["netloc"], to["path"])).alias("is_image"),
    )


def _page_steps(pages, keep, url, html):
    """`keep` columns, the parts of the page's own URL, and its references."""
    live = F.when(F.col(html).contains("<"), F.regexp_replace(html, _INERT, "")).otherwise("")
    references = F.filter(
        staged(
            F.regexp_extract_all(live, F.lit(_TAG), F.lit(1)),
            _reference, _step(_unquoted), *[_step(change) for change in UNESCAPE_STEPS],
        ),
        lambda r: F.when(r["on_image"], r["to"] != "").otherwise(followable(r["to"])),
    )
    base = F.get(staged(F.array(F.col(url)), trimmed, split_parts), F.lit(0))
    return pages.select(*keep, base.alias("_base"), references.alias("_references"))


def _links():
    """The distinct links behind the references of a page."""
    ends = staged(
        F.col("_references"),
        _step(trimmed), _step(split_parts), _step(lambda ref: merge_parts(F.col("_base"), ref)),
        _step(settle_path), _finished,
    )
    wanted = F.filter(ends, lambda r: ~r["on_image"] | r["is_image"])
    return F.array_distinct(staged(wanted, lambda r: r.dropFields("on_image")))


def with_links(pages, keep=(), url="url", html="html"):
    """`keep` columns and `links`: the distinct (link, netloc, is_image) of each page.

    Anchors of any domain, without their fragment, and images of any domain as written.
    Every page stays; one without links has an empty list.
    """
    return _page_steps(pages, keep, url, html).select(*keep, _links().alias("links"))


def page_links(pages, keep=(), url="url", html="html"):
    """One row per distinct link of a page: `keep` columns, link, netloc, is_image.

    Restrict by domain with `allowed_link`.
    """
    # exploding the expression itself: over a named column Spark would add a filter on
    # its size and work out all links twice
    steps = _page_steps(pages, keep, url, html)
    return steps.select(*keep, F.explode(_links()).alias("_to")).select(*keep, "_to.*")


def allowed_link(allowed_netloc):
    """Same-domain links, and images wherever they are."""
    return (F.col("netloc") == allowed_netloc) | F.col("is_image")
