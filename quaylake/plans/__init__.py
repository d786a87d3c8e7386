"""Bronze, silver, gold and report jobs, composed from the operators."""
