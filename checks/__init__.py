"""The registered checks and the log files they write: fixtures, not part of the package."""
