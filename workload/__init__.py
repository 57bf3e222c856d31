"""Input shapes, named queries and their SQL counterparts for the test tables."""
