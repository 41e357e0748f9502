"""textmill: prepare, tokenise and measure text corpora as Spark jobs."""
