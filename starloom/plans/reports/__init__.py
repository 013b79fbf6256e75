"""The report library: every report is a function of a Star."""
