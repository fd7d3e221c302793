"""Find under which of its names a university is stored."""

from pyspark.sql import functions as F

from quadrangle.constants import UNIVERSITY_ALIASES
from quadrangle.functions.text import slug


def candidate_names(hint):
    """Known aliases, then the hint as given, in lower case, and as a slug; no repeats."""
    known = F.array().cast("array<string>")
    for name, aliases in UNIVERSITY_ALIASES.items():
        known = F.when(hint == name, F.array(*[F.lit(a) for a in aliases])).otherwise(known)
    return F.array_distinct(F.concat(known, F.array(hint, F.lower(hint), slug(hint))))


def resolve_universities(requested, stored):
    """Add `university`, the first candidate stored for the faculty or else the hint, and `found`.

    `requested`: hint, faculty. `stored`: university, faculty of the existing folders.
    """
    names = F.posexplode(candidate_names(F.col("hint"))).alias("pos", "university")
    tried = requested.select("hint", "faculty").distinct().select("hint", "faculty", names)
    known = stored.select("university", "faculty").distinct().withColumn("is_stored", F.lit(True))
    first = F.min(F.when(F.col("is_stored"), F.struct("pos", "university"))).alias("first")
    return (
        tried.join(known, ["university", "faculty"], "left")
        .groupBy("hint", "faculty")
        .agg(first)
        .select(
            "hint",
            "faculty",
            F.coalesce("first.university", "hint").alias("university"),
            F.col("first").isNotNull().alias("found"),
        )
    )
