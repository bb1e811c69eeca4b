"""tidewell — customer and media analytics as Spark DataFrame operators.

Every operator is a function from DataFrames (plus a small parameter object)
to a DataFrame.  Plans are declared with the DataFrame / SQL API so Catalyst
does pushdown, pruning and join selection; Python only runs on the driver for
model-fitting loops over tiny parameter tables.
"""

__version__ = "0.1.0"
