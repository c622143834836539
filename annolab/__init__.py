"""annolab: annotation-to-evaluated-classifier toolkit expressed as Spark jobs.

Sub-packages
------------
sources    readers / writers (annotation files, labelled tables, caches, models)
functions  Column-expression builders (JSON extraction, tokens, ordinal maths)
operators  DataFrame -> DataFrame operators (vote, anti-join, split, profile,
           vocabulary, metrics, histories, model fit / scoring)
plans      compositions of operators into the end-to-end stages and the
           registered query catalogue
streaming  the same stateless projections on a file stream
"""

from annolab.config import Settings, DEFAULTS

__all__ = ["Settings", "DEFAULTS"]
