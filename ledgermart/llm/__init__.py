"""Training-data operators: fingerprints, dedup, quality, privacy, tokens, packing, shards.

Nothing outside this subpackage imports it.  ``queries.QUERIES`` holds one thin query per
operator, ``queries.SQL`` the DuckDB SQL of those that SQL can express.
"""
