"""tessera: schema-parameterised analytics operators on Spark DataFrames.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame; nothing is collected except small scalars that parameterise
a plan. Sub-packages:

* ``sources``   - typed readers, mart registration, checked writers
* ``functions`` - column-expression helpers (ratios, bands, normal CDF, ...)
* ``operators`` - profiling, cleaning, joins, marts, windows, features,
                  experiments, splits, preparation, models, metrics
* ``plans``     - driver-table wiring: the registered queries and jobs
* ``streaming`` - Structured Streaming variants of the batch jobs
"""

from tessera.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
