"""tonemill: binary text classification over large corpora, on Spark DataFrames."""
