"""Reliability of batch data pipelines: run metrics, bounded labels, checked joins and reports."""
