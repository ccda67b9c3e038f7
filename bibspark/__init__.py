"""Analytics over large catalogues of nested records, as plain DataFrame functions."""
