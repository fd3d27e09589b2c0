"""DataFrame operators: contract, quality, features, preprocessing, joins,
splits, evaluation, ranking, set operations, training and scoring."""
