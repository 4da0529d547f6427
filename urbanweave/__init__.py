"""Spark-native harmonisation of city energy, cadastre, boundary, vegetation and weather data.

Inputs are DataFrames; outputs are triples ``(s, p, o, o_kind)`` and bucketed time series.
"""
