"""The operators applied to the shared test tables, each with equivalent SQL."""
