"""Operations of a training-data pipeline: decontamination, personal data, quality,
piece encoding, language-model scoring, language identification, substring and
near-duplicate removal, exact top-k search.

Each operator takes and returns DataFrames. Nothing else in the package imports
this subpackage.
"""
