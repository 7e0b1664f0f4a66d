"""Operators for a large-scale training-data pipeline (formatting, extraction, decontamination,
filtering, near-duplicate detection, mixing, token output). Nothing outside this subpackage
imports it; its queries are in ``orderpulse.llm.queries``."""
