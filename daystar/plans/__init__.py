"""Silver, dimension, fact, mart and publishing plans, and the job that runs them."""
