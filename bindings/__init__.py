"""Which operator runs on which test table."""

from bindings import flagship, loading, models, profiles, quality, scores, tests_of_difference, wide_models
from bindings.registry import BINDINGS

__all__ = ["BINDINGS", "flagship", "loading", "models", "profiles", "quality", "scores", "tests_of_difference", "wide_models"]
