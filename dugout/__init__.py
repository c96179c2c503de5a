"""dugout — season-level sports analytics as lazy PySpark DataFrame operators.

Layers (mirroring a raw -> analytics -> marts warehouse):

* ``dugout.sources``   typed CSV loading, fixture tables, table sinks and refresh jobs
* ``dugout.functions`` column expressions: exact half-up ratios, rate stats, text helpers
* ``dugout.operators`` generic DataFrame operators (top-k, rank filter, baselines,
                       z-scores, calibrated constants, expectations, award envelopes)
* ``dugout.plans``     the domain instance: staging, aggregates, awards, sabermetrics,
                       marts, data-quality ledger, query-log rollup

Every public function takes DataFrames and returns a lazy DataFrame; actions happen only
in sinks, gates and tests.
"""

from dugout.params import Params

__all__ = ["Params"]
