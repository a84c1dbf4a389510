"""All queries of this subpackage; importing the operators registers them."""

from fieldlake.llm import bpe, chat, decontaminate, lexical, licences, mixing, pivots, quality, repeats, sharding, simhash, url_filter, whitening  # noqa: F401
from fieldlake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
