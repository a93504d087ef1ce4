"""Queries over the given tables, one or more per operator."""

from ledgerline.queries import cleaning, evaluation, features, models, profiles, scoring, series, sources, splits
from ledgerline.queries.base import REGISTRY, Query

__all__ = [
    "REGISTRY", "Query", "cleaning", "evaluation", "features", "models", "profiles", "scoring", "series", "sources",
    "splits",
]
