"""All registered queries and their SQL; importing this module registers them."""

from alluvia.plans import check_queries, geometry_queries, scalar_queries, storage_queries  # noqa: F401
from alluvia.plans.registry import ORACLES, QUERIES  # noqa: F401
