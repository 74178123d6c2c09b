"""Bindings and registered queries."""

from . import evidence, feeds, files, geometry  # noqa: F401 - importing registers
from .catalogue import ORACLES, QUERIES  # noqa: F401
