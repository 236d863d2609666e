"""The engine's queries on the driver's tables, and their SQL twins."""
