"""Operators for building training corpora out of document tables.

Every operator takes DataFrames and returns DataFrames.  Nothing outside this
package imports it; ``registry`` lists its queries for the entry module.
"""
