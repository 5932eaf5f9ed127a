"""Training-data operators: sharding, filtering, de-duplication, packing.

Every operator takes and returns DataFrames.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it; its queries are registered in ``queries.py``.
"""
