"""Operators for preparing training text at scale.

Each module holds one operator with a general interface (DataFrame in,
DataFrame out); ``queries`` holds the registered queries built on them.
Nothing outside this folder imports it.
"""
