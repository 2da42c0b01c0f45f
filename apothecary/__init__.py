"""Annual statistics on dispensing contractors, as Spark DataFrames.

Transactions become a contractor fact (``operators.fact``), the fact becomes
extracts of 118 measures (``plans.extracts``), and the extracts become summary
tables, chart datasets and trend measures (``plans``).
"""
