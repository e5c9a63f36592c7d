"""DataFrame to DataFrame operators. Only ``ordered`` runs a job while building a plan."""
