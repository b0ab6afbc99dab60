"""The registered queries. Importing the modules fills the registry."""

from sortlane.catalog import (  # noqa: F401
    evaluation_queries,
    label_queries,
    model_queries,
    rule_queries,
    text_queries,
)
from sortlane.catalog.registry import QUERIES

__all__ = ["QUERIES"]
