"""Operators for preparing training data: near-duplicate search, toxicity and
quality scoring, web archives, packing, fingerprints, mixing, language
identification and token files.  Nothing outside this package imports it.

Conventions shared by all operators

* An operator reads only the columns named by its parameters, so further
  columns, whatever their names, never clash with its own.
* A null text counts as the empty text unless the operator says otherwise.
* ``doc_id`` names a document: rows that repeat an id are one document stored
  more than once, and a decision about an id holds for all of its rows.
* An empty table gives an empty result with the same columns.
"""
