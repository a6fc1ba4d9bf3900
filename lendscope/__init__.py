"""lendscope: consumer-loan risk analytics as plain Spark DataFrame operators.

Every public function takes DataFrames (or a SparkSession plus paths) and
returns a DataFrame; nothing collects data to the driver. Sub-packages:

* ``sources``   - the star-schema testbed, CSV/Parquet scans and sinks, catalog tables
* ``functions`` - Column-level helpers (member key, text parsing, rule bands)
* ``operators`` - split, clean, profile, quarantine, consolidate, score
* ``plans``     - the staged end-to-end flow and the query registry
"""

from lendscope.rules import ScoreRules, DEFAULT_RULES  # noqa: F401

__all__ = ["ScoreRules", "DEFAULT_RULES"]
