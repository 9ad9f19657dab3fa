"""Spark jobs that build, check and prepare spoken two-party dialogue datasets."""
