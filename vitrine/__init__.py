"""Click-stream warehouse on Spark: parse shop events, build dimensions and facts, analyse them."""
