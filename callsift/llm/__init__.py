"""Training-data operators: search, deduplication, sharding, tokens, packing, filters.

Rules that hold for every operator of this subpackage, unless its docstring
says otherwise:

* a null text counts as the empty text;
* only the identifier and the columns an operator names are read, under private
  names, so further columns never clash;
* an empty table gives an empty result with the same columns;
* repeated rows (same identifier, same text) are treated as separate rows with
  one decision each, equal for all of them.
"""
