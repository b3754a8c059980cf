"""Operators for preparing large text corpora for model training.

Each module holds one operator with its own general interface; ``queries``
registers one thin ``opN_<name>`` query per operator. Nothing else in the
library imports this subpackage.
"""
