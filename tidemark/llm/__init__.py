"""Training-data operators: one module per operator, each taking and returning DataFrames.

Nothing outside this folder imports it.  ``queries`` holds the registered
``opN_`` queries; the pipeline over them is ``corpus_pipeline.py`` at the top of
the repository.
"""
