"""Training-data operators over documents, pages and embeddings.

One module per operator, each with a general interface; ``registry`` holds the
thin queries.  Nothing else in the library imports this subpackage.
"""
