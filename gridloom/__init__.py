"""Curation of asset catalogues, relational algebra over sparse volumes and meshes, on Spark DataFrames."""
