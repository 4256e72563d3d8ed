"""Operators for preparing large training corpora.

Each module holds one operator with its own general interface.  ``queries``
registers them over the given tables.  Nothing else in the library imports this
package.
"""
