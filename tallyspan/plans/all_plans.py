"""Imports every plan module, so that all queries are registered."""

from tallyspan.plans import facts, logs, retrieval, sessions, streams  # noqa: F401
from tallyspan.plans.registry import ORACLES, QUERIES  # noqa: F401
