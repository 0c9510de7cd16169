"""Every operator as a query on the given tables."""

from tonemill.queries import evaluation, features, modelling, profiling, text  # noqa: F401
from tonemill.queries.registry import ORACLES, QUERIES  # noqa: F401
