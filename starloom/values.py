"""Fixed values of the data contract. They must stay exactly as they are for results to match."""

# Written in place of an unknown string. The spelling is part of the contract.
UNKNOWN_TEXT = "TO BE DETERMINATED"

# Written in place of an unknown number, whatever its numeric type.
UNKNOWN_NUMBER = -1

# Characters removed from every standardised text.
REMOVED_CHARACTERS = ("'", ",", "-", ".")

# A line holding one of these is unknown as a whole ...
LINE_MARKERS = ("UNKNOWN", "NO PORT")
# ... and from one of these on, the rest of the line is unknown.
TAIL_MARKERS = ("INVALID", "COLLAPSED", "NO COUNTRY")

# Day 0 of the day-number columns.
DAY_ZERO = "1960-01-01"
