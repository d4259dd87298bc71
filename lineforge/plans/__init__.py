"""The steps from raw lines to reports, made of operators."""
