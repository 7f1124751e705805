"""Operators for text corpora that become training data.

Each module holds one operator with a general interface; :mod:`tablebridge.llm.queries` derives the
contract queries ``opN_<name>`` from them. Nothing outside this subpackage imports it.
"""
