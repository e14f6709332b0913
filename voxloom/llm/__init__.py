"""Operators of the training-data problems that concern language-model corpora."""

from __future__ import annotations


def registries() -> list:
    from . import queries

    return [queries.REGISTRY]
