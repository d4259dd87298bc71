"""Operations of a training-data pipeline over documents, pages, conversations and vectors.

Nothing else in the library imports this subpackage. One module per operation; ``registry``
holds the registered queries and ``oracle`` the SQL of those that have one; all are tested by brute force.
"""
