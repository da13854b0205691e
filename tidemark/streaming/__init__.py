"""Streaming entry point.

The checked batches of the rule-driven flow (a ``batch_id`` per load) map
onto Structured Streaming micro-batches: ``quality_batch_writer`` returns a
function for ``writeStream.foreachBatch`` that runs the end-to-end check on
each micro-batch and appends its report. No operator of its own.
"""

from .micro_batch import quality_batch_writer

__all__ = ["quality_batch_writer"]
