"""Training-data operators: ten stand-alone components over text, page and vector tables.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
