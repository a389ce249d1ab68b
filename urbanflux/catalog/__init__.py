"""Registered queries over the given tables."""

from . import aggregates, inputs, joins, modelling, quality, scalars, shapes, windows  # noqa: F401
from .base import REGISTRY  # noqa: F401
