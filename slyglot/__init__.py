"""Evasive-text labeling, corpus collection and label evaluation on Spark."""

from slyglot.lexicons import Lexicons

__all__ = ["Lexicons"]
