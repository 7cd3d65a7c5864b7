"""Daily market and macro-economic data as Spark DataFrame operators."""
