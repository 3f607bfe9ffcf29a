"""Spark-first scholarly analytics: DataFrame operators over publication, authorship and event tables."""
