"""quillview: denormalised document views over changing tables, on Spark.

Layers
------
``config``     tag language, table / column / inline specifications, validation
``sources``    snapshot, change log, binary copy files, CSV, synthetic data
``functions``  JSON fragments, identifiers, null handling as Column expressions
``operators``  op-log construction, fold, nest, join field, bulk packing, metrics
``plans``      catalog queries, read-side queries, the registry of queries
``streaming``  incremental maintenance with Structured Streaming
"""

__version__ = "0.1.0"
