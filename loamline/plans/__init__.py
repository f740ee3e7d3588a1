"""The engine's queries by name, and the SQL that states their results."""

from loamline.plans import catalogue, runs  # noqa: F401
from loamline.plans.catalogue import ORACLES, QUERIES  # noqa: F401
