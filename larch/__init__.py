"""larch: supervised learning on trip-like tables, expressed as Spark jobs.

Data reduction, targets, features, splits, model fits, evaluation,
hyperparameter search and run tracking are DataFrame / MLlib plans.
"""

__version__ = "0.1.0"
