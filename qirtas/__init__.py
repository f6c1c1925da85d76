"""qirtas: a Spark-first analytics engine for multilingual document collections."""
