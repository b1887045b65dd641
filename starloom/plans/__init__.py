"""Whole dimensions, facts and schemas put together from the operators."""

from starloom.plans.dimensions import build_dimension, build_lookup
from starloom.plans.facts import build_fact, clean_fact_source

__all__ = ["build_dimension", "build_fact", "build_lookup", "clean_fact_source"]
