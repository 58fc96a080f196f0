"""Training-data operators: one module an operator, their registered queries in :mod:`.queries`."""
