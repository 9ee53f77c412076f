"""Train-fitted preprocessing, regressors and importances on MLlib."""
