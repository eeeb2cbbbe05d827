from basketry.plans.oracle import ORACLE  # noqa: F401
from basketry.plans.queries import QUERIES  # noqa: F401
