"""Training-data operators (text filters, de-duplication, packing, scoring).

Nothing else in the package imports this folder.  Every operator is a
``DataFrame -> DataFrame`` function with its own parameters; ``registry`` holds
the thin registered queries.
"""
