"""Cleansing, deduplication, daily totals and publishing for business records, as Spark jobs."""
