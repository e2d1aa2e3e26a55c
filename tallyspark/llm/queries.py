"""All queries of this subpackage and the SQL that must give the same rows."""

from . import collocations, decontam, fixity, langid, line_dedup, neighbours, packing, page_text, pieces, resampling, simhash, suffix_dedup, toxicity  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401

import corpus_pipeline  # noqa: E402, F401
