"""Spark jobs for institutional web, document and bibliographic data."""
