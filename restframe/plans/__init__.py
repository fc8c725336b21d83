"""The registered queries, one per operator, each with the SQL that checks it."""

from restframe.plans import decoding, joins, logs, planning, retries, sinks, status, stores
from restframe.plans.base import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "decoding", "joins", "logs", "planning", "retries", "sinks", "status", "stores",
]
