"""Training-data operators: token counts, mixing, BPE, near-dedup, neighbours, language ID, WARC, suffix dedup, top-k, sharding.

Nothing outside this subpackage imports it.  Workers import it by name, so on a cluster ship the package with
``--py-files`` or install it on the executors.
"""
