"""Brute-force versions shared by the tests of this folder."""

from test_mix_decontam import edit
from test_ngram_join import brute

__all__ = ["brute", "edit"]
