"""The two book reports, wired from the operators."""
