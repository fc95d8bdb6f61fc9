"""viewstar: product-view clickstream analytics on Spark.

Decode and clean click events, deduplicate them under a watermark, build a
star schema (date, product, location, customer dimensions around an event
fact), load it batch by batch with an exactly-once ledger, audit its keys,
and answer the daily view reports -- all as Spark DataFrame plans.
"""

from viewstar.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
