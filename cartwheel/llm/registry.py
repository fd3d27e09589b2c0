"""Registered queries of this folder and their DuckDB twins."""

from __future__ import annotations

from cartwheel.llm import bpe_trie, exact, fingerprint, hardneg, langid, near, packing, periodic, quality, secrets, suffix, tokenfile, warc

MODULES = (suffix, near, quality, fingerprint, packing, tokenfile, langid, warc, secrets, bpe_trie, periodic, hardneg, exact)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
