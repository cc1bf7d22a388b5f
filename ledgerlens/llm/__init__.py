"""Training-data operators: ten operators over ``documents`` and ``pages``.

Nothing else in the library imports this package. Each module holds one
operator with its general interface and the registered query ``opN_<name>``
that applies it to a whole table; ``registry`` collects the queries.
"""
