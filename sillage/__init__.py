"""sillage: customer-journey analytics as Spark DataFrame operators.

Every public operator takes and returns DataFrames, so the same function serves a
batch table and a streaming micro-batch.  Sub-packages:

* ``sources``   – event schemas on the wire, JSON decode, CSV, the test-table views
* ``functions`` – column expressions (derivations, rules, hashes)
* ``operators`` – features, dashboard analytics, data quality, text, ML, governance, sinks
* ``streaming`` – Structured Streaming jobs built from the same operators
* ``plans``     – the named query catalogue used by ``__spark_entry__`` and the bench
"""

__version__ = "0.1.0"
