"""lapworks: a Spark-native medallion pipeline for timed-event (lap) data.

Bronze (landed payloads) -> Silver (conformed, flagged, enriched) -> Gold
(leaderboards, standings, rolling series) -> reports, with declarative data
quality checks gating each layer.  Every operator is a ``DataFrame ->
DataFrame`` function built from Spark SQL expressions; column names are
parameters so the same operators run on any table of timed events.
"""

__version__ = "0.1.0"
