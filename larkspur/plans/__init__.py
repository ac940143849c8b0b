"""The query catalogue: one named query per operator, with its SQL twin."""
