"""Column -> Column functions. None of them shuffles."""
