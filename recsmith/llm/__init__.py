"""Training-data pipeline operators (documents, embeddings).

Each module holds one operator with a general DataFrame interface;
``queries.py`` applies them with production parameters to the standard tables.
Nothing outside this subpackage imports it.
"""
