"""The driver's tables seen as this engine's tables, and one query with its SQL per operator."""
