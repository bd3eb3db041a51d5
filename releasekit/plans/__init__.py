"""Query plans over the test tables; importing this package registers them all."""

from releasekit.plans.base import ORACLE, QUERIES  # noqa: F401
from releasekit.plans import q_tables  # noqa: F401
from releasekit.plans import q_registry  # noqa: F401
from releasekit.plans import q_release  # noqa: F401
