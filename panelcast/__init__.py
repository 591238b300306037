"""panelcast — Spark-native feature, validation and scoring engine for
spatio-temporal demand panels (cells observed at regular time slots).

Sub-packages
------------
sources    readers / writers and the panel fixtures derived from the given tables
functions  column-expression builders (time, geohash, statistics)
operators  DataFrame -> DataFrame operators (lags, encodings, imputation, folds, ...)
plans      composite jobs (base features, encodings, training, scoring, profile)
streaming  micro-batch scoring / calibration with Structured Streaming
"""

from panelcast.schema import PanelSpec

__all__ = ["PanelSpec"]
__version__ = "0.1.0"
