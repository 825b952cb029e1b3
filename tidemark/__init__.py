"""Point-in-time-correct customer event analytics on Spark DataFrames.

``sources`` reads and writes, ``functions`` holds column expressions, ``operators`` turns
frames into frames, ``plans`` strings them into the preprocessing, modelling and scoring runs,
and ``streaming`` scores arriving histories.
"""
