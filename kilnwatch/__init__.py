"""Factory sensor telemetry on Spark: flatten, store, index and watch readings.

Every transform takes and returns a DataFrame. The stateless ones work on batch
and streaming inputs alike; keyed state lives in :mod:`kilnwatch.streaming`.
"""
