"""tidemart: a Spark-native batch and incremental engine for nested order data.

Landing JSON envelopes -> raw variant tables -> typed staging frames -> a star
schema (product and date dimensions, order-item fact, daily sales summary)
maintained by keyed upserts -> data-quality gate -> reports and upsert payloads.
Every stage is a DataFrame -> DataFrame function; Catalyst plans the work.
"""

__version__ = "0.1.0"
