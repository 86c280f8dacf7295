"""Training-data operators: scoring, search, dedup, filtering, encoding, sharding.

Nothing else in the package imports this subpackage; ``queries`` registers its
named queries and the entry file adds them when the subpackage is present.
Modules run inside executors, so a cluster needs the package on the workers'
Python path (``--py-files`` or an installed wheel).
"""
