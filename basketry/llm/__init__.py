"""Training-data operators for very large corpora.

Thirteen operators, one module each, plus the thin ``opN_<name>`` queries over the
test tables in :mod:`basketry.llm.queries`. Nothing else in the library
imports this package; ``corpus_pipeline.py`` chains five of them.
"""
