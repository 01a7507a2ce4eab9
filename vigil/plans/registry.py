"""Collects every contract module's registrations."""

from __future__ import annotations


def all_queries():
    from . import contract, contract_ensemble, contract_stream  # noqa: F401  (they register on import)

    return dict(contract.REGISTRY)
