"""Sinks: the fraud table (idempotent micro-batch writer), validated files,
reconciliation rows and report files."""
