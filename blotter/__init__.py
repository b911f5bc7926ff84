"""blotter -- Spark-native analytics over dated, located incident records.

Layers:

* ``blotter.sources``   -- declared schemas; CSV / text-line / Parquet I/O.
* ``blotter.functions`` -- Column -> Column cleaning, bands, recoding, distance.
* ``blotter.operators`` -- joins with size-checked strategies, ranking, aggregates, union.
* ``blotter.plans``     -- the four report pipelines, each returning a lazy DataFrame.
"""

from blotter.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
__version__ = "0.1.0"
