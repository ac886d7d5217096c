"""The registered queries (``catalog``) and their SQL oracles (``oracle``)."""
