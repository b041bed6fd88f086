"""All registered queries; importing the modules registers them."""

from lumenrec.plans import q_jobs, q_lists, q_search, q_sources, q_stream  # noqa: F401
from lumenrec.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
