"""All named queries."""

from lograil.plans import letters, parsing, serving, streams  # noqa: F401
from lograil.plans.registry import ORACLES, QUERIES  # noqa: F401
from lograil.plans.serving import flagship  # noqa: F401
