from riffle.queries import features, models, relational, storage  # noqa: F401
from riffle.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
