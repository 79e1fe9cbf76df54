"""Map-ready layer tables as PySpark DataFrame operators.

Packages:

* ``functions``: column expressions (geometry, colour, text, hashing, sizes)
* ``operators``: DataFrame in, DataFrame out
* ``sources`` / ``sinks``: reading, generating and writing layer tables
* ``streaming``: interaction streams and the layer change feed
* ``plans``: end-to-end jobs and the registered queries
"""

from layerspark.spec import Extension, LayerSpec, MapSpec

__all__ = ["Extension", "LayerSpec", "MapSpec"]
