"""DataFrame operators: documents, discovery, flattening, writes, lineups."""
