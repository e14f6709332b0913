"""Queries over the test tables, one per operator."""

from __future__ import annotations

from .tables import Registry


def registries() -> list[Registry]:
    from . import pipeline, problems, steps

    return [problems.REGISTRY, pipeline.REGISTRY, steps.REGISTRY]
