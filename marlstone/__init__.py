"""marlstone: document-intelligence analytics expressed as Spark plans."""
