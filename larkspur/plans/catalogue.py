"""Importing this module fills the catalogue."""

from larkspur.plans import content, learning, recommend, relational, scalar, streams, tables  # noqa: F401
from larkspur.plans.registry import CATALOGUE  # noqa: F401
