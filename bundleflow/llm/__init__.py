"""Training-data operators: each module is one operator built by one named method.

Nothing else in the library imports this subpackage.  ``queries.py`` registers one
query per operator.
"""
