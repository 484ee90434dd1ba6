"""lapstats: lap-by-lap panel analytics on Spark DataFrames.

Entry points by topic (all take and return DataFrames, lazily):

* ``lapstats.operators.clean``  -- validation and cleaning (P1-P17)
* ``lapstats.operators.panel``  -- sequence features, pit detection, split (W1-W9, J1)
* ``lapstats.operators.stats``  -- reports and aggregates (A1-A15, T, U)
* ``lapstats.operators.model``  -- distributed random forest and baseline (M1-M9)
* ``lapstats.functions.exprs``  -- scalar Column expressions (F1-F23)
* ``lapstats.plans``            -- race and state pit-stop planning (G1-G12)
* ``lapstats.sources``          -- landing-file ingest and partitioned sinks (S1-S12)
* ``lapstats.streaming``        -- incremental ingest of landing files
"""

__version__ = "0.1.0"
