"""Training-data operators: one module per operator, registered in ``queries.py``.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
