"""Batch analytics on Spark DataFrames: readers, series features, linear models, evaluation.

The sub-packages:

* ``sources``    readers and writers for text, delimited, headered CSV, LIBSVM and labelled rows
* ``functions``  Column expressions: tokens, strict casts, labels, thresholds, number text
* ``operators``  DataFrame in, DataFrame out: counts, ordering, splits, joins, series, models, metrics
* ``plans``      whole jobs with their default parameters, and the query catalog
"""

__version__ = "0.1.0"
