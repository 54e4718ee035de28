"""Composable DataFrame operators: joins, aggregations, windows, validation and explorer queries."""
