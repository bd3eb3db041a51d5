"""All queries of the subpackage: importing the operators registers them."""

from releasekit.llm import cap_filters, collocations, decontaminate, html_text, licenses, middle_fill, minhash, packing, quality_rules, secrets, sentence_dedup, toxicity, url_filter  # noqa: F401
from releasekit.llm.base import ORACLE, QUERIES  # noqa: F401
