"""Registered queries over the given tables, each with an independent SQL statement where SQL can say it."""

from . import analytics, extraction, history, jobs, listings, loading, news, reference

_MODULES = (analytics, loading, listings, extraction, reference, news, jobs, history)


def queries() -> dict:
    return {k: q for m in _MODULES for k, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
