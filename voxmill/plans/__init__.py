"""Importing the query modules fills the registry."""

from voxmill.plans import (  # noqa: F401
    cleaning, complaints, evaluation, insights, products, profile, retrieval, storage,
)
from voxmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
