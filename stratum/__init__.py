"""stratum: Spark-native preparation and evaluation of wide, sparse, imbalanced tables.

Every fitted step returns a small parameter DataFrame and is applied as an ordinary
Spark projection or join. Sub-packages:

* ``sources``   – delimited/JSON scans, coercion, parameter and label sinks
* ``functions`` – Column-level helpers (portable hashing, clipping, label codes)
* ``operators`` – profiling, cleaning, imputation, transforms, splits, evaluation
* ``plans``     – compositions: prepare fit/apply, model sweeps, ensembles, publishing
* ``streaming`` – stateless apply of fitted parameters to streaming DataFrames
"""

__version__ = "0.1.0"
