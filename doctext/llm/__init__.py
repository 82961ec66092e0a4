"""Training-data operators: quality, packing, rules, deduplication, language
model scoring, licences, sharding, mixing, conversation repair, main text of
pages and alignment of tokenizers.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and returns DataFrames; ``queries.py`` holds the thin registered queries.
"""
