"""Operations of a training-data pipeline over text and embedding tables.

One module per operation; ``queries.py`` registers a query for each. Nothing outside this
package imports it.
"""
