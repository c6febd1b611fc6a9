"""cumulus: data-modelling and product-analytics operators on Spark DataFrames.

Every operator is a pure function ``DataFrame(s) -> DataFrame`` built from
built-in Spark SQL expressions, so Catalyst can push filters, prune columns
and pick join strategies.  See README.md for the operator catalogue.
"""

__version__ = "0.1.0"
