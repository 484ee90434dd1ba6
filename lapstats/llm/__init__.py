"""Training-data pipeline operators over document, page and embedding tables.

One module per operator; ``catalog`` registers a query for each. Nothing outside this
folder (and ``corpus_pipeline.py``) imports it.
"""
