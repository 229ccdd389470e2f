"""dimloom — incremental registry warehouse on Spark.

Feeds land as JSON, are shaped with builtin column expressions, deduplicated
deterministically, tracked with one watermark per source, grown into
insert-only dimensions with stable dense ids, and folded into one
denormalised mart by a partial-column upsert. Every operator is a plain
DataFrame -> DataFrame function, so the same code serves batch runs and
``foreachBatch`` on a stream.
"""

from dimloom.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
