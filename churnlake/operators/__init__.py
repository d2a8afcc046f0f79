"""DataFrame operators: profiling, cleaning, features, folds, encodings, joins, models, evaluation."""
