"""Regulatory-document processing on Spark: frontiers, links, records, keyed documents."""
