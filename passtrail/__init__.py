"""passtrail: compiler-pass dump streams to a queryable snapshot corpus, on Spark."""
