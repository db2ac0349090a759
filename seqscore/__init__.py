"""seqscore: Spark-native scoring and ranking of peptide sequences and
their predicted structures.

Entry points:

* ``seqscore.operators``: DataFrame -> DataFrame operators (structure
  metrics and score, global rank and splits, pairing, validation, reports,
  descriptors);
* ``seqscore.sources`` / ``seqscore.sinks``: file and table IO;
* ``seqscore.streaming``: resumable incremental scoring;
* ``seqscore.plans.stages``: file-in/file-out stages (also ``python -m seqscore``);
* ``seqscore.plans.catalog``: the registered queries over the given tables.
"""

__version__ = "0.1.0"
