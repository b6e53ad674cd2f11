"""harborline: commerce analytics as composable Spark DataFrame operators.

Three subject areas share one set of landing tables:

* orders         - keep the latest version, quarantine the rest, daily facts
* reconciliation - pair gateway transactions with ledger entries, tier by tier
* advertising    - unify ad exports, attribute revenue, return on ad spend

Every operator takes DataFrames and returns a DataFrame.
"""

__version__ = "0.1.0"
