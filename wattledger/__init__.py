"""Contract settlement and revaluation of an electricity book, as Spark DataFrame plans."""
