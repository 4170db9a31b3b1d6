"""Spark-native supervised learning on wide tables, from raw rows to scored rows."""

from rowan.spec import CUSTOMER_SPEC, DatasetSpec

__all__ = ["CUSTOMER_SPEC", "DatasetSpec"]
