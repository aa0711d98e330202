"""Ready-made stars."""

from starloom.models.health_plans import HEALTH_PLANS
from starloom.models.order_lines import ORDER_LINES

__all__ = ["HEALTH_PLANS", "ORDER_LINES"]
