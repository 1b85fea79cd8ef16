"""quillspan: reference-anchored text-corpus analytics expressed in Spark DataFrames."""
