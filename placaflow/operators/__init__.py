"""Reusable DataFrame operators: joins, first-by-key, aggregates, ordering, unions."""
