"""tempora: keyed, scale-safe DataFrame operators for daily series and the
dimensional tables built on them.

* ``sources``   -- raw text ingest with lineage, landing manifest, sinks, and
  the six daily series derived from the test tables
* ``operators`` -- cleaning waterfall + ledger, calendar / time dimension,
  keyed and ordered-block windows, forward fill, data-quality checks
* ``functions`` -- Column builders for returns, volatility, ranges, regimes,
  bands, parity forwards, guarded correlation, quantiles, option premium
* ``plans``     -- Silver / Gold plans, reports, catalog documentation, the
  keyed event metrics, the batch job and the study wiring
* ``streaming`` -- the Bronze load as an incremental available-now stream

Every public operator maps DataFrame -> DataFrame and keeps its work on
Spark: no Python UDFs and no driver-side collection of data.
"""

__version__ = "0.1.0"
