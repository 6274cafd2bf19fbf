"""bandwise: Spark-native retail demand-forecast features, scoring and per-band error reports.

Every operator is a lazy ``DataFrame -> DataFrame`` function over the public
DataFrame / SQL / MLlib API, usable through ``df.transform``.
"""

__version__ = "0.1.0"
