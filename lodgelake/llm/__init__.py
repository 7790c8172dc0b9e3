"""Training-data operators: scoring, filtering, matching and mixing of documents.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` uses it.
"""
