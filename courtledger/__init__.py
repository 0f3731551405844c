"""Sports-results warehousing and data quality as plain PySpark DataFrame jobs."""

from courtledger.session import build_session
from courtledger.warehouse import Warehouse

__all__ = ["Warehouse", "build_session"]
