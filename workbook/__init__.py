"""Queries over the given tables, by chapter, each with the SQL that gives the same rows."""

from workbook import evaluation, features, inference, runlogs, sources, training

CHAPTERS = [sources, features, training, inference, evaluation, runlogs]
