"""Spark-native analytics for public feedback collected as tracker issues."""

from echolot.config import IngestConfig, IssueFilter

__all__ = ["IngestConfig", "IssueFilter"]
