"""quarry: reusable DataFrame operators for PySpark.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that Catalyst can see through. Registered plans over the driver
tables live in :mod:`quarry.plans`; each one carries the DuckDB SQL that
states the same result.
"""

__version__ = "0.1.0"
