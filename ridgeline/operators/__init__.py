"""DataFrame -> DataFrame operators: cleaning, profiling, joins, distributions, ordered
running sums and quantiles, evaluation metrics, sampling and splits."""
