"""simpairs: similarity search and similar-pair joins on Spark DataFrames.

Subpackages:

* ``sources``    – table scans, derived inputs, sinks and saved parameters
* ``functions``  – column expressions (hashing, shingling)
* ``operators``  – sketches, banding index, random projection, pair shaping
* ``plans``      – the end-to-end jobs and the registered queries
* ``streaming``  – Structured Streaming sketch upkeep and index probing
"""

__version__ = "0.1.0"
