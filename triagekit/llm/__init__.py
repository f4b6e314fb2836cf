"""Operators for preparing large text and embedding corpora.

Each module holds one operator with its own interface; ``queries`` registers
the named queries that apply them to the whole tables. Nothing outside this
package imports it.
"""
