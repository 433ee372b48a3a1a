"""Operators of a training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Common rules, true of every operator unless its docstring says otherwise:

* columns are picked by name at the start, so further columns, whatever their
  names, neither disturb an operator nor reach its result;
* a null text counts as the empty text; a null id is carried through as null;
* an empty table gives an empty result of the same schema.
"""
