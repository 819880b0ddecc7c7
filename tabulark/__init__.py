"""Outcome analytics, image-table jobs and a streaming text committer on Spark."""
