"""Every operator as a named query over the given tables, with its SQL check."""

from catalogue import explore, extract, features, join, model, prep, reshape, select, sources, stream, text  # noqa: F401
from catalogue.registry import CHECKS, QUERIES  # noqa: F401
