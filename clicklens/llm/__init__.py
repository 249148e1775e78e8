"""Operators for preparing training text at scale.

Ten operators, each in a module of its own, and ``queries``, which applies
every one of them to its whole table. Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
