"""tessera: Spark-native batch, SQL, streaming and ML operators.

Each operator is a lazy function ``DataFrame -> DataFrame`` with column
names as parameters.  ``tessera.plans.queries`` wires them onto the test
tables; ``tessera.plans.oracle`` holds the equivalent DuckDB SQL.
"""

__version__ = "0.1.0"
