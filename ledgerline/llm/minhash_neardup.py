"""The former name of similar_neardup, whose candidates were MinHash bands."""

from .similar_neardup import groups, shingles

__all__ = ["groups", "shingles"]
