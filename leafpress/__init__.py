"""Spark jobs that turn page transcripts into a checked, searchable corpus."""
