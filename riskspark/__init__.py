"""Loan-portfolio credit risk on Spark: features, scores, stages, reports and model development."""
