"""docloom: document-corpus preparation as Spark plans."""
