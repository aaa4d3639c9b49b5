"""sylvan: tree-ensemble regression analytics on Spark DataFrames.

Sub-packages
------------
sources    table loaders, model-ready frames, synthetic sets, file sinks
functions  column-expression helpers (portable hashing, safe ratios)
operators  cleaning, features, scaling, splitting, split search, forest
           fit/score, metrics, model store, cross-validation, grid search
plans      named pipelines (presets) built from the operators
streaming  Structured Streaming scoring with a stored model
"""

__version__ = "0.1.0"
