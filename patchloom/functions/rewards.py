"""Reward columns. A patch column comes from ``extract_patch``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reward scale.
NO_PATCH, WEAK_PATCH, FULL_PATCH = 0.0, 0.1, 0.5
BAD_IMPORT, PASSED, NOT_PASSED = -20.0, 1.0, 0.0
FORMAT_WEIGHT, TEST_WEIGHT = 0.3, 0.7
PASS_MARK = "PASS"


def format_reward(patch: Column) -> Column:
    """0 without a patch, 0.5 for a patch with both signs and both headers, else 0.1."""
    minus = patch.startswith("-") | patch.contains("\n-")
    plus = patch.startswith("+") | patch.contains("\n+")
    headers = patch.contains("---") & patch.contains("+++")
    return (
        F.when(patch.isNull(), NO_PATCH).when(minus & plus & headers, FULL_PATCH).otherwise(WEAK_PATCH)
    )


def log_passed(stdout: Column) -> Column:
    """Whether a harness log counts as a pass: a plain substring test."""
    return stdout.contains(PASS_MARK)


def test_reward(
    has_patch: Column,
    imports_allowed: Column,
    has_task: Column,
    passed: Column,
    fallback: Column,
) -> Column:
    """Harness reward; ``fallback`` (the format reward) where no log exists."""
    return (
        F.when(~has_patch, NO_PATCH)
        .when(~imports_allowed, BAD_IMPORT)
        .when(~has_task, fallback)
        .when(passed.isNull(), fallback)
        .when(passed, PASSED)
        .otherwise(NOT_PASSED)
    )


test_reward.__test__ = False  # not a pytest case


def hybrid_reward(
    fmt: Column, test: Column, w_f: float = FORMAT_WEIGHT, w_t: float = TEST_WEIGHT
) -> Column:
    return F.lit(float(w_f)) * fmt + F.lit(float(w_t)) * test


def combine_rewards(cols: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Weighted sum of reward columns; no weights means 1 each, a null reward adds 0."""
    weights = [1.0] * len(cols) if weights is None else [float(w) for w in weights]
    if len(weights) != len(cols):
        raise ValueError(f"{len(cols)} rewards but {len(weights)} weights")
    terms = [F.lit(w) * F.coalesce(c, F.lit(0.0)) for c, w in zip(cols, weights)]
    return reduce(lambda a, b: a + b, terms)
