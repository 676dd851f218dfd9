"""All registered queries of this subpackage."""

from __future__ import annotations

import corpus_pipeline  # noqa: F401
from tierwatch.llm import (best_fit_packing, chat_format, cross_entropy, decontaminate, direct_codes,  # noqa: F401
                           line_dedup, phrases, quality_classifier, quality_rules, set_join, sharding, url_filter,
                           whitening)
from tierwatch.llm.registered import ORACLES, QUERIES  # noqa: F401
