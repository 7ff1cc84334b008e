"""Named queries over the given tables, each with SQL that states the expected result."""

from rowsmith.queries import cleaning, evaluation, features, registry, splitting, streams, training
from rowsmith.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "evaluation", "features", "registry", "splitting", "streams", "training"]
