"""Spark-native threat-evidence analytics.

Feeds land in one evidence table (the CDR), identifiers are extracted, records
are mapped to linked-entity statements, statements are merged and framed into
documents, and the same tables feed the audit, ground-truth and search reports.
"""
