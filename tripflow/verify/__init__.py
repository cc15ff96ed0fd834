"""Every operator run over the supplied tables, and the same in plain SQL."""
