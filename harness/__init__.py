"""The given test tables seen as grid data, and the queries checked on them."""
