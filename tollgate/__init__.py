"""tollgate: contract-checked record pipelines as Spark DataFrame plans.

Landed responses and topic messages are parsed once into VARIANT, checked
against declarative contracts, flattened, routed to an accepted table or a
dead-letter table, and summarised by ordinary aggregate queries.  Every
operator is DataFrame -> DataFrame or Column -> Column built from Spark SQL
expressions; there is no Python UDF on any path.
"""

__all__ = ["functions", "operators", "sources", "streaming", "plans"]
