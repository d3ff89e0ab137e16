"""visitlab: web-visit and ad-click analytics on Spark DataFrames.

Sub-packages:

* ``sources``   -- table readers, derived views, task parameters, log parsing, JDBC
* ``functions`` -- column expressions: dates, strings, ratios, optional predicates
* ``operators`` -- reusable relational operators: skew-safe joins and aggregates,
                   bounded broadcast, keyed table merges, per-group top-k
* ``plans``     -- the analytics: sessions, sampling, categories, page funnel,
                   area products, ad clicks
* ``streaming`` -- Structured Streaming jobs over ad-click logs
"""

from visitlab.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
