"""Sources, the keyed store with its ledger, and sinks."""
