"""Part of the ledgerscope engine."""
