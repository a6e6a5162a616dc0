"""The registered queries: the operators run over the shared test tables."""
