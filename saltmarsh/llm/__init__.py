"""Operators for building language-model training corpora.

Nothing outside this subpackage imports it; its queries live in ``saltmarsh.llm.queries``.
"""
