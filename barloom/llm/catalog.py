"""The registered queries of this subpackage, each with a SQL statement where SQL can say it."""

from . import brown, contentsort, decontamination, divergence, extraction, packing, periodic, quality, sharding, simhash, topk, toxicity, warc

_MODULES = (topk, toxicity, warc, sharding, quality, decontamination, packing, simhash, extraction, brown, contentsort, divergence, periodic)


def queries() -> dict:
    return {k: q for m in _MODULES for k, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
