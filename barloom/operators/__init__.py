"""DataFrame operators: DataFrame in, DataFrame out, nothing is collected."""
