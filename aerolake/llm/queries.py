"""The queries of this subpackage; importing the operators registers them."""

from aerolake.llm import backoff, boilerplate, byte_pairs, merkle, mixing, near_duplicates, packing, pseudonyms, quality, repeats, tiles, url_lists, whitening  # noqa: F401
from aerolake.llm.common import ORACLES, QUERIES  # noqa: F401
