"""aloft: analytics over flights, places, social graphs and players, written as
Spark DataFrame / SQL / pyspark.ml jobs.

Layout:
  sources/    typed readers for the raw inputs (CSV, TSV, text dumps, parquet)
  functions/  reusable column expressions (haversine, flags, dates, words)
  operators/  parameterised DataFrame operators (relational, percentile,
              time series, text, geo, graph, ml)
  plans/      the user-facing question APIs (flights, places, players) and the
              registered queries over the shared parquet tables
"""

from aloft.session import build_session, checkpoint_dir, ensure_checkpoint_dir


def __getattr__(name):
    # the drop-in classes, imported on first use (they pull in pyspark.ml)
    if name in ("FlightAnalytics", "PlaceAnalytics", "PlayerModel", "SocialGraph"):
        from aloft import plans
        return getattr(plans, name)
    raise AttributeError(name)


__all__ = ["FlightAnalytics", "PlaceAnalytics", "PlayerModel", "SocialGraph", "build_session",
           "checkpoint_dir", "ensure_checkpoint_dir"]
