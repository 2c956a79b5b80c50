"""Operators for large training-data corpora, on Spark.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator (``opN_<name>``) over the test tables and
``corpus_pipeline.py`` at the repository top chains five of them. Nothing else
in the library imports this package.

  url_rules        op1   longest-match URL rules by a sorted sweep
  near_dedup       op2   MinHash near-duplicate classes
  sharding         op3   near-equal byte shards by sampled splitters
  decontaminate    op4   benchmark passages by template windows
  language_id      op5   hyperdimensional letter profiles
  mixing           op6   Poisson replication to target weights
  substring_dedup  op7   repeated 50-word windows, count-min prefilter
  secret_scan      op8   secrets by trigram index and regex check
  fingerprints     op9   SimHash fingerprints and Hamming search
  quality          op10  line-level CRF quality score
  vector_codes     op11  product quantisation with anchors-hierarchy trees
  hard_negatives   op12  hard negatives by multiway trees with distance ranges
  jaccard_join     op13  3-word shingle sets of similarity 0.9, light and heavy

Helpers: ``words`` (vectorised words and hashes inside tasks), ``tables``
(intermediate tables in the shared checkpoint folder), ``components``
(connected components), ``bitmaps`` (fixed-size filters).
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so a
# cluster's workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
