"""The queries of this package and their SQL, for the driver."""

from __future__ import annotations

from importlib import import_module

_QUERIES = {
    "op1_token_counts": ("token_counts", "op1_token_counts", None),
    "op2_exact_dedup": ("exact_dedup", "op2_exact_dedup", "OP2_SQL"),
    "op3_url_filters": ("url_filters", "op3_url_filters", "OP3_SQL"),
    "op4_html_extraction": ("html_extract", "op4_html_extraction", None),
    "op5_decontaminate": ("decontaminate", "op5_decontaminate", "OP5_SQL"),
    "op6_chat_format": ("chat_format", "op6_chat_format", "OP6_SQL"),
    "op7_minhash": ("minhash", "op7_minhash", None),
    "op8_sentencepiece": ("sentencepiece_sampling", "op8_sentencepiece", None),
    "op9_warc": ("warc", "op9_warc", "OP9_SQL"),
    "op10_toxicity": ("toxicity", "op10_toxicity", None),
}


def queries() -> dict:
    return {name: getattr(import_module(f"topicloom.llm.{module}"), fn) for name, (module, fn, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"topicloom.llm.{m}"), sql) for name, (m, _, sql) in _QUERIES.items() if sql}
