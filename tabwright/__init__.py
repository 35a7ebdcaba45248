"""tabwright: Spark-native cleaning, validation, reconciliation and diffing of tabular registers."""
