"""Tidemark: subscription analytics from messy source extracts, on Spark.

Sources (`tidemark.sources`) -> staging and marts (`tidemark.plans`), built
from generic operators (`tidemark.operators`: dedup, SCD2 from snapshots,
temporal join, data expectations, health checks, profiles) and column
helpers (`tidemark.functions`). `tidemark.plans.pipeline.run` is the nightly
job; `tidemark.catalog` lists the named queries.
"""

__version__ = "0.1.0"
