"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

from loadcast.llm import (decontaminate, divergence, fingerprints, html_text, langid, lm, mixing, near_dups, quality,
                          repeats, resampling, toxicity, warc)

MODULES = [toxicity, html_text, warc, quality, decontaminate, mixing, lm, repeats, near_dups, langid,
           fingerprints, resampling, divergence]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
