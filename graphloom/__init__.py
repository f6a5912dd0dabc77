"""graphloom: gene graphs, transcript sets and training corpora as Spark DataFrames."""
