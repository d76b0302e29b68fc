"""Table builders: typed and staged tables, dimensions, the sales fact, features and the end-to-end warehouse."""
