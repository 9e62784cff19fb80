"""sentinela: disease-surveillance analytics as lazy Spark DataFrame operators.

Subpackages
-----------
functions   column expressions (calendar, numeric parsing, text)
sources     typed readers for the surveillance inputs and the test tables
operators   DataFrame -> DataFrame operators (counts, windows, joins, anomaly, ...)
plans       end-to-end entries (A, B, C) and the registered test-table queries
streaming   incremental (file-stream) versions of the counting pipeline
sinks       writers: CSV/Parquet, partition replace, round-trip check
"""

from sentinela.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
__version__ = "0.1.0"
