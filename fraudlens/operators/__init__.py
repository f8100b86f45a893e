"""Operators over DataFrames: cleaning, joins, ordering, graphs, metrics, models, logs."""
