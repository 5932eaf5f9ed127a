"""feedlake: accommodation-feed curation as plain Spark DataFrame operators.

Layout
------
functions/  Column -> Column expressions (text, numeric, arrays, structs)
operators/  DataFrame -> DataFrame relational operators (joins, aggregates,
            generators, frame shaping)
sources/    feed readers, curated-state access and sinks (upsert, append, CSV)
plans/      the domain pipelines composed from the operators
streaming/  incremental (file-stream) runner for the same batch plans
catalog/    the registered queries and their independent SQL oracles
"""

__version__ = "0.1.0"
