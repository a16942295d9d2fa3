"""Operators for preparing text corpora for language-model training.

Nothing else in the package imports this one. Every operator takes a frame and
column names, selects the columns it needs under names of its own (so extra or
clashing columns do no harm), and never keeps rows of an unbounded group in one
task.
"""
