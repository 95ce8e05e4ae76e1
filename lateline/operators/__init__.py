"""DataFrame -> DataFrame steps from raw observations to marts, and the audits on them."""
