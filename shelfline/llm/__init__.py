"""Operators that prepare text for training language models; see the README for one line on each."""
