"""Imports every module that registers queries (order = report order)."""

from pricelens.plans import q_offers  # noqa: F401
from pricelens.plans import q_catalog  # noqa: F401
from pricelens.plans import q_deals  # noqa: F401
from pricelens.plans import q_state  # noqa: F401
from pricelens.plans import q_confidence  # noqa: F401
from pricelens.plans import q_sources  # noqa: F401
from pricelens.plans import q_feeds  # noqa: F401
from pricelens.plans import q_streaming  # noqa: F401
from pricelens.plans import q_sinks  # noqa: F401
