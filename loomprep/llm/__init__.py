"""Operators for preparing training data.  Nothing else in the library imports
this subpackage; its queries are in the ``*_query`` functions of each module
and are collected in ``llm.catalog``."""
