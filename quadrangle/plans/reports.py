"""Reporting views over the curated tables, and the four reports."""

from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.operators.slots import SLOT

_PROFILE_NAMES = {
    "full_name": "name",
    "works_count": "publications_count",
    "cited_by_count": "citations_count",
    "source_system": "source",
    "business_timestamp": "crawl_timestamp",
}
_COURSE_NAMES = {
    "course_name": "title",
    "text_content": "raw_content",
    "source_system": "source",
    "business_timestamp": "crawl_timestamp",
}


def _report_view(df, names, schema):
    renamed = df.withColumnsRenamed(names)
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in renamed.columns
    }
    return renamed.withColumns(missing).select(*schema.names)


def profile_report_view(profiles):
    """Profiles under their reporting names; columns nobody fills are NULL."""
    return _report_view(profiles, _PROFILE_NAMES, schemas.PROFILE_REPORT)


def course_report_view(courses):
    """Courses under their reporting names; a `level` or `department` is taken if present."""
    return _report_view(courses, _COURSE_NAMES, schemas.COURSE_REPORT)


def register_views(profiles, courses):
    """Make both views available to SQL."""
    profile_report_view(profiles).createOrReplaceTempView("faculty_profiles")
    course_report_view(courses).createOrReplaceTempView("course_catalog")


def _rows_per(view, key, name):
    return view.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def staff_per_faculty(view):
    return _rows_per(view, "faculty", "nb_profs").orderBy(F.desc("nb_profs"), "faculty")


def courses_per_level(view):
    return _rows_per(view, "level", "nb_cours").orderBy(F.desc("nb_cours"), "level")


def staff_per_university(view):
    return _rows_per(view, "university", "nb_profs")


def publications_per_university(view):
    total = F.sum("publications_count").alias("total_publications")
    return view.groupBy("university").agg(total).orderBy(F.desc("total_publications"), "university")


CURATED = {
    "faculty_profiles": (schemas.PROFILE, _PROFILE_NAMES, schemas.PROFILE_REPORT),
    "course_catalog": (schemas.COURSE, _COURSE_NAMES, schemas.COURSE_REPORT),
}
KEPT = "_kept"


def declare_tables(spark, paths, database="university_db"):
    """Declare what the upserts keep as tables, and the reporting names as views over them.

    `paths`: {"faculty_profiles": path, "course_catalog": path}. The table `<name>_kept` is
    the upsert's own folders, nothing is copied; the view `<name>` has the reporting names,
    columns nobody fills being NULL. May be run again; `refresh_tables` follows upserts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in paths.items():
        schema, names, report = CURATED[name]
        folders = ["university", "faculty", SLOT]
        kinds = {f.name: f.dataType.simpleString() for f in schema.fields} | {SLOT: "bigint"}
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in [*[n for n in schema.names if n not in folders], *folders])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}{KEPT}` ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(folders)}) LOCATION '{path}'"
        )
        given = {new: old for old, new in names.items()}
        shown = [
            f"`{given.get(f.name, f.name)}` AS `{f.name}`" if given.get(f.name, f.name) in schema.names
            else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in report.fields
        ]
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {', '.join(shown)} FROM `{database}`.`{name}{KEPT}`")
    refresh_tables(spark, paths, database)


def refresh_tables(spark, names, database="university_db"):
    """Make folders that upserts added or split known to the tables."""
    for name in names:
        spark.sql(f"REFRESH TABLE `{database}`.`{name}{KEPT}`")
        spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}{KEPT}` SYNC PARTITIONS")


REPORTS = {
    "staff_per_faculty": ("faculty_profiles", staff_per_faculty),
    "courses_per_level": ("course_catalog", courses_per_level),
    "staff_per_university": ("faculty_profiles", staff_per_university),
    "publications_per_university": ("faculty_profiles", publications_per_university),
}


def run(spark, database="university_db"):
    """The reports over the declared tables, by name."""
    return {name: report(spark.table(f"`{database}`.`{table}`")) for name, (table, report) in REPORTS.items()}
