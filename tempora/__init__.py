"""tempora: time-bucketed analytics on Spark DataFrames and streams.

Every public function takes and returns DataFrames (or Columns); nothing holds a
global session. Sub-packages:

- ``tempora.functions``  scalar Column builders (time buckets, parsing, JSON, series maths)
- ``tempora.sources``    batch / stream readers and keyed sinks
- ``tempora.operators``  projections, aggregates, joins, windows, views, profiles, ML
- ``tempora.plans``      the composite jobs (bucketed join, explore table, retrain, ...)
- ``tempora.streaming``  Structured Streaming jobs (scoring, upserts, windowed averages)
- ``tempora.cli``        spark-submit entry points (refresh-view, retrain, score, land)
- ``tempora.constants``  the fixed values (names, widths, lookbacks, model parameters)
- ``tempora.session``    session settings, the shared checkpoint folder, data-sized settings
"""

from tempora.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
