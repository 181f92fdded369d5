"""Training-data operators (documents, pages, labels) and the corpus pipeline's building blocks.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries.py`` registers the thin ``opN_<name>`` queries over it.
"""
