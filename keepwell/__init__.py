"""keepwell: retail retention analytics written as Spark DataFrame programs."""
