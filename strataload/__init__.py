"""Set-based warehouse loading on Spark: staging, entities, star schema, history and checks."""
