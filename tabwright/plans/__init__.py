"""The query catalogue: every operator over the test tables, with its SQL check."""
