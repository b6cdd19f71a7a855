"""skyledger: daily weather-risk analytics as Spark DataFrame operators."""
