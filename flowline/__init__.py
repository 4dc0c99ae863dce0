"""flowline: Spark-native image-classification data work at table scale.

Ingest image files as rows, refine them into training tables with
reproducible splits and a stored label vocabulary, feed shards and
mini-batches to a synchronous data-parallel softmax trainer, search
hyper-parameters, keep runs and model versions as tables, and score whole
tables with a packaged model.
"""

__version__ = "0.1.0"
