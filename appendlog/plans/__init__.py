"""Range planning: the decision table as Column expressions and as a Python twin."""
