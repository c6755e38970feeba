"""factorloom: cross-sectional factor research on Spark DataFrames.

``functions`` hold Column -> Column building blocks, ``operators`` DataFrame -> DataFrame steps,
``sources`` readers and writers, ``plans`` the end-to-end jobs put together from them.
"""
