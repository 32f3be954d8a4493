"""Domain models: compositions of the operators over the declared source tables.

Each model is a function from DataFrames to a DataFrame. One plan may span all
layers; materialise a model where several others read it.
"""
