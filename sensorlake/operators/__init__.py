"""Pipeline operators: DataFrame in, DataFrame out."""
