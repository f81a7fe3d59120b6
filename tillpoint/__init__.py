"""tillpoint: retail and e-commerce analytics expressed as Spark DataFrame plans.

Every operator is a function from DataFrames to DataFrames; the heavy lifting is
left to Catalyst and the Spark runtime (shuffles, joins, windows, state).
"""

__version__ = "0.1.0"
