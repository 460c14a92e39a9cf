"""textloom: text-corpus preparation and profiling as Spark DataFrame operators.

Every public operator is a function from DataFrame(s) to a DataFrame built on
Spark SQL expressions, windows, joins, aggregations and Structured Streaming.
Nothing collects documents to the driver; the only driver round trips are
bounded scalars (a row count, a per-partition count table, a BPE merge batch).
"""

__version__ = "0.2.0"
