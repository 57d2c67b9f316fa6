"""Filters, joins, windows and keyed logic over DataFrames."""
