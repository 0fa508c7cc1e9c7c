"""All queries of this subpackage; importing the operator modules registers them."""

from riffle.llm import alignment, bpe, centroids, decontaminate, fingerprint, langid, licenses, linededup, lm, minhash, prefix_bpe, secrets, urlfilter  # noqa: F401
from riffle.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
