"""Operators: detectors, data-quality checks, reconciliation and report tables."""
