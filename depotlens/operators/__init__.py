"""DataFrame -> DataFrame operators of the depot book."""
