"""skyfold: a Spark-native batch ELT and star-schema engine.

Raw nested JSON batches are flattened into typed tables, loaded batch by
batch with idempotent partition replacement, and modelled into staging
views, surrogate-key dimensions and fact tables.  Data-quality checks,
run-state bookkeeping and retention run as Spark jobs next to the models.
Everything is expressed with DataFrame / SQL operators so Catalyst and AQE
choose the physical plan.
"""

__version__ = "0.1.0"
