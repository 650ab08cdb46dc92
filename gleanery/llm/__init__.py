"""Training-data operators over the tables documents, pages, labels.

One module per operator; ``queries`` registers the thin ``opN_`` queries.
Nothing outside this subpackage imports it.
"""
